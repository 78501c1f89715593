"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemart.llm import clusters, collision, hamming, language, licenses, mixing, pieces, quality
from tidemart.llm import phrases, shards, simhash, token_counts, transcripts
from tidemart.llm.shared import held_out, table


def model_file(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_license_scan(spark, d):
    return licenses.scan(table(spark, d, "documents"))


def op2_hamming_top_k(spark, d):
    """Sign codes of all embeddings, queries every hundredth, ten nearest codes."""
    return hamming.similar_signs(table(spark, d, "embeddings"))


def op3_mix(spark, d):
    return mixing.mix(table(spark, d, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"))


def op4_shards(spark, d):
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return shards.shuffled(table(spark, d, "documents")).select(
        "doc_id", shards.text_size("text").alias("size"), crc.alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_quality(spark, d):
    held = held_out("doc_id", 4, 2)
    found = quality.scored(table(spark, d, "documents"), table(spark, d, "labels"), ~held)
    return found.select("doc_id", held.alias("held_out"), "score", "predicted")


def op6_language(spark, d):
    documents = table(spark, d, "documents").select("doc_id", "text", "lang")
    held = held_out("doc_id", 3, 1)
    model = language.fit(documents, ~held)
    return language.predict(documents.select("doc_id", "text"), model).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score")


def op7_collision_ann(spark, d):
    return collision.near(table(spark, d, "embeddings"))


def op8_chat_format(spark, d):
    """All conversations as raw transcripts, parsed and rendered again."""
    rows = transcripts.as_transcript(table(spark, d, "conversations"))
    return transcripts.parse(rows, transcripts.fit(rows)).select(
        "conv_id", "turn", "part", "role", "rendered")


def op9_sentencepiece(spark, d):
    found = pieces.sampled(table(spark, d, "documents"), model_file())
    return found.withColumn("n_pieces", F.size("ids"))


def op10_simhash(spark, d):
    return simhash.near_duplicates(table(spark, d, "documents")).select(
        "doc_id", simhash.fingerprint_text().alias("fingerprint"), "component_id")


def op11_token_counts(spark, d):
    return token_counts.counted(table(spark, d, "documents"), model_file("word_bpe_49k.json"))


def op12_clusters(spark, d):
    return clusters.clustered(table(spark, d, "embeddings"))


def op13_phrases(spark, d):
    return phrases.collocations(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_hamming_top_k, op3_mix, op4_shards, op5_quality, op6_language,
    op7_collision_ann, op8_chat_format, op9_sentencepiece, op10_simhash, op11_token_counts,
    op12_clusters, op13_phrases)}
