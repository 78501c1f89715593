"""Operators on documents: odd rows, brute force, round trips, held-out accuracy."""

import collections
import math
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemart.llm import language, licenses, minhash, mixing, pieces, quality, shards, simhash, stages
from tidemart.llm.queries import model_file
from tidemart.llm.shared import components, held_out, table

SF = "/root/testdata/sf0.01"


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


# --- license scan -------------------------------------------------------------------
def words(text):
    low = (text or "").translate(str.maketrans(licenses.UPPER, licenses.LOWER))
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def plain_scan(text):
    w = words(text)
    places, base, labels, score = [], set(), set(), 0.0
    for t in licenses.TEMPLATES:
        if t.phrase:
            at = [p for p in range(len(w)) if w[p:p + len(t.words)] == t.words]
            places += at
            if at:
                base.add(t.label)
                labels.add(t.label)
                score = 1.0
            continue
        s, kinds = 0, set(t.words)
        while s == 0 or s + t.stride < len(w):
            share = len(kinds & set(w[s:s + 2 * t.stride]))
            if share >= t.needed:
                labels.add(t.label)
                score = max(score, share / len(kinds))
            s += t.stride
    return (len(w), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), score)


def test_scan_equals_brute_force(documents, odd):
    far = " ".join(["wort"] * 61)
    notice = "this work is licensed under the gnu general public license version 3"
    made = documents([(i, t, "en", "s") for i, t in enumerate([
        f"{far} MIT License {far} the apache license", f"{far} {notice} {far}", notice[:-12],
        "licensed under cc by nc 4", "general public license " * 50, "mit license" * 3,
        "permission granted", f"{far} mit {far} license"])])
    for df in (made, odd):
        got = sorted((tuple(r)[1:] for r in licenses.scan(df).collect()), key=repr)
        want = sorted((plain_scan(r["text"]) for r in df.select("text").collect()), key=repr)
        assert got == want


def test_scan_of_nothing(empty):
    assert licenses.scan(empty).count() == 0


# --- mixing ---------------------------------------------------------------------------
def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, full = dict.fromkeys(names, 0.0), set()
    budget = share * sum(sizes.values())
    while True:
        rest = budget - sum(most * sizes[s] for s in full)
        total = sum(weight[s] for s in names if s not in full)
        for s in names:
            target[s] = most * sizes[s] if s in full else rest * weight[s] / total
        above = {s for s in names if s not in full and target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


def test_mix_targets_and_takes(documents, odd):
    rng = np.random.default_rng(1)
    many = documents([(i, "w " * int(rng.integers(0, 30)), "en", rng.choice(["a", "b", "c", "é", None]))
                      for i in range(3000)])
    for df in (many, odd):
        source = {(r["doc_id"], r["text"]): r["source"] for r in df.collect()}
        found = mixing.mix(df).collect()
        sizes = collections.Counter()
        for r in df.collect():
            sizes[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        target = plain_targets(sizes)
        assert len(found) == len(df.collect()) and {r["times"] for r in found} <= {0, 1, 2}
        assert {round(r["target"], 6) for r in found} == {round(t, 6) for t in target.values()}
        assert rows_of(mixing.mix(df), "doc_id", "times") == rows_of(mixing.mix(df), "doc_id", "times")
    by_id = {i: s for (i, _), s in source.items()}
    taken = collections.Counter()
    owner = {r["doc_id"]: r["source"] for r in many.collect()}
    for r in mixing.mix(many).collect():
        taken[owner[r["doc_id"]]] += r["times"] * r["size"]
    want = plain_targets({s: sum(len(r["text"].split()) for r in many.collect() if r["source"] == s)
                          for s in set(owner.values())})
    assert all(abs(taken[s] - want[s]) <= 30 for s in want) and by_id


def test_mixed_repeats_rows_whole(odd, empty):
    times = {}
    for r in mixing.mix(odd).collect():
        times[r["doc_id"]] = r["times"]
    got = collections.Counter(tuple(r) for r in mixing.mixed(odd).collect())
    for row, n in collections.Counter(tuple(r) for r in odd.collect()).items():
        assert got[row] == n * times[row[0]]
    assert mixing.mixed(odd).columns == odd.columns
    assert mixing.mix(empty).count() == mixing.mixed(empty).count() == 0


def test_larger_mix_holds_the_smaller(documents):
    df = documents([(i, "w " * (i % 7 + 1), "en", "a") for i in range(500)])
    small = {r["doc_id"] for r in mixing.mix(df, share=0.2).collect() if r["times"]}
    large = {r["doc_id"] for r in mixing.mix(df, share=0.6).collect() if r["times"]}
    assert small < large


@pytest.mark.parametrize("equal", [True, False])
def test_a_key_with_a_third_of_the_rows_is_taken_in_part(documents, equal):
    # only this key, so that the boundary is in it: with equal rows, or with different texts
    df = documents([(None, "w w w" if equal else f"w w {i}", "en", "a") for i in range(300)])
    found = mixing.mix(df, share=0.35).select("size", "times").collect()
    assert len(found) == 300 and sum(r["times"] for r in found) == 105
    assert mixing.mixed(df.repartition(5), share=0.35).count() == 105


# --- shards ----------------------------------------------------------------------------
def test_shards_are_a_permutation(spark, documents, odd, empty):
    many = documents([(i, "x" * (i % 50), "en", "s") for i in range(2000)])
    for df in (many, odd):
        found = shards.shuffled(df, bucket_bytes=4096).collect()
        assert collections.Counter(tuple(r)[:-2] for r in found) == collections.Counter(
            tuple(r) for r in df.collect())
        slots = collections.defaultdict(list)
        for r in found:
            slots[r["shard"]].append(r["slot"])
        counts = [len(slots[s]) for s in range(8)]
        assert max(counts) - min(counts) <= 1
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert rows_of(shards.shuffled(many), "doc_id", "shard", "slot") == rows_of(
        shards.shuffled(many.repartition(7)), "doc_id", "shard", "slot")
    order = [r["doc_id"] for r in shards.shuffled(many).orderBy("slot", "shard").collect()]
    moved = np.corrcoef(order, np.arange(len(order)))[0, 1]
    assert abs(moved) < 0.1
    assert shards.shuffled(empty).count() == 0


def test_copies_of_one_record_are_spread(documents, monkeypatch):
    monkeypatch.setattr(shards, "COPIES_AT_ONCE", 70)
    many = documents([(None, None, "en", "s")] * 400 + [(i, f"text {i}", "en", "s") for i in range(200)])
    found = shards.shuffled(many, bucket_bytes=4096)
    rows = [r["doc_id"] for r in found.orderBy("slot", "shard").collect()]
    assert len(rows) == 600 and collections.Counter(rows)[None] == 400
    assert sum(r is None for r in rows[:300]) in range(150, 250)
    again = shards.shuffled(many.repartition(5), bucket_bytes=4096)
    assert rows_of(found, "doc_id", "shard", "slot") == rows_of(again, "doc_id", "shard", "slot")


def test_shards_are_written(spark, documents, folder):
    df = documents([(i, f"text {i}", "en", "s") for i in range(100)])
    shards.write_shards(df, f"{folder}/shards")
    back = spark.read.parquet(f"{folder}/shards")
    assert back.count() == 100 and back.select("shard").distinct().count() == 8


# --- SimHash ---------------------------------------------------------------------------
def plain_fingerprint(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(
        str.maketrans(licenses.UPPER, licenses.LOWER))) if x]
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42)
              for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_classes_equal_brute_force(documents, odd):
    base = "one two three four five six seven eight nine ten " * 6
    made = documents([(100 - i, base + " ".join(f"w{j}" for j in range(i % 9)), "en", "s")
                      for i in range(40)])
    for df in (made, odd):
        rows = simhash.near_duplicates(df).select(
            "doc_id", simhash.fingerprint_text().alias("f"), "component_id").collect()
        texts = {(r["doc_id"], f"{plain_fingerprint(r['text']):016x}") for r in df.collect()}
        assert {(r["doc_id"], r["f"]) for r in rows} == texts
        roots = plain_components([int(r["f"], 16) for r in rows])
        least = {}
        for r, root in zip(rows, roots):
            if r["doc_id"] is not None:
                least[root] = min(least.get(root, 1 << 60), r["doc_id"])
        assert [r["component_id"] for r in rows] == [least.get(x) for x in roots]


def test_crowded_blocks_are_linked_without_pairs(spark):
    """Groups beyond `largest` give the same classes as pairs do."""
    rng = np.random.default_rng(3)
    start = int(rng.integers(0, 1 << 63))
    fps = {start}
    while len(fps) < 300:       # a walk: neighbours differ by 1 or 2 bits, ends by many
        x = list(fps)[rng.integers(0, len(fps))]
        for _ in range(rng.integers(1, 4)):
            x ^= 1 << int(rng.integers(0, 63))
        fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    roots = plain_components(fps)
    want = {frozenset(f for f, r in zip(fps, roots) if r == root) for root in set(roots)}
    for largest in (2, 1000):
        node = components(simhash.links(df, largest=largest)).collect()
        sets = collections.defaultdict(set)
        for r in node:
            sets[r["root"]] |= {r["root"], r["node"]}
        linked = {frozenset(s) for s in sets.values()}
        assert linked == {s for s in want if len(s) > 1}


def test_one_of_each_class_stays(odd, empty):
    kept = stages.without_near_duplicates(odd)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    classes = {r["component_id"] for r in simhash.near_duplicates(odd).collect()}
    assert len(ids) == len(set(ids)) == len(classes) and set(ids) == classes
    assert stages.without_near_duplicates(empty).count() == 0


def test_near_copies_at_four_fifths_go(documents):
    rng = np.random.default_rng(8)

    def text(n):
        return [f"w{x}" for x in rng.integers(0, 5000, n)]

    def grams(words):
        return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}

    rows, gone = [], set()
    for i in range(60):
        base = text(200)
        near = list(base)
        for place in (20, 60, 100, 140)[:1 + i % 4]:
            near[place] = "edited"
        a, b = grams(base), grams(near)
        assert len(a & b) / len(a | b) >= 0.8
        rows += [(10 * i, " ".join(base), "en", "s"), (10 * i + 1, " ".join(near), "en", "s")]
        gone.add(10 * i + 1)
        far = list(base)
        for place in range(5, 200, 15):
            far[place] = "changed"
        rows.append((10 * i + 2, " ".join(far), "en", "s"))
    # a crowd of texts with one passage, of which pairs are near copies
    passage = text(150)
    for i in range(80):
        own = text(70)
        rows += [(2000 + 2 * i, " ".join(passage + own), "en", "s"),
                 (2001 + 2 * i, " ".join(passage + own + ["end"]), "en", "s")]
        gone.add(2001 + 2 * i)
    df = documents(rows)
    kept = {r["doc_id"] for r in stages.without_near_duplicates(df).collect()}
    assert kept == {r[0] for r in rows} - gone


@pytest.mark.parametrize("common", [None, 3])
def test_no_pair_of_a_large_crowd_is_missed(documents, monkeypatch, common):
    """300 texts with one long passage, 0.75 alike, among them 150 pairs just above 0.8."""
    if common:
        monkeypatch.setattr(minhash, "MOST_COMMON", common)
    rng = np.random.default_rng(9)
    passage = [f"p{x}" for x in rng.integers(0, 9000, 154)]
    rows = []
    for i in range(150):
        base = passage + [f"own{i} {k}" for k in range(13)]
        near = " ".join(base).split()
        for place in (30, 80, 120):
            near[place] = f"edit{i} {place}".replace(" ", "x")
        rows += [(2 * i, " ".join(base), "en", "s"), (2 * i + 1, " ".join(near), "en", "s")]
    sets = [set(minhash.shingles(t.encode()).tolist()) for _, t, _, _ in rows]
    alike = [len(sets[2 * i] & sets[2 * i + 1]) / len(sets[2 * i] | sets[2 * i + 1]) for i in range(150)]
    assert 0.8 <= min(alike) and max(alike) < 0.86
    assert max(len(sets[0] & s) / len(sets[0] | s) for s in sets[2:]) < 0.8
    kept = {r["doc_id"] for r in stages.without_near_duplicates(documents(rows)).collect()}
    assert kept == set(range(0, 300, 2))


def test_components_of_a_chain(spark):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["root"] for r in components(edges).collect()} == {0}


# --- pieces ------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def tiny():
    pieces_of = {p: (i, r) for i, (p, r) in enumerate([
        (" ", 9.0), ("a", 5.0), ("b", 6.0), ("c", 7.0), (" a", 1.0), ("ab", 2.0), ("bc", 3.0),
        ("abc", 4.0), (" ab", 2.5)], 256)}
    return pieces.Vocabulary(pieces_of, list(range(256)))


def every_path(v, text):
    """All segmentations with their probabilities."""
    out = {}

    def go(at, codes, weight):
        if at == len(text):
            out[tuple(codes)] = weight
        for n in range(1, len(text) - at + 1):
            found = v.table.get(text[at:at + n])
            if found and found[1]:
                go(at + n, [*codes, found[0]], weight * found[1])
        if not (v.table.get(text[at:at + 1]) or (0, 0))[1] and at < len(text):
            go(at + 1, [*codes, v.size + ord(text[at])],
               weight * v.byte_weight ** len(text[at].encode()))
    go(0, [], 1.0)
    total = sum(out.values())
    return {k: w / total for k, w in out.items()}


def test_samples_follow_the_gumbel_top_k_law(tiny):
    text = "abcé ab"
    law = every_path(tiny, " " + text)
    n = 6000
    found = pieces.sample(pieces.Lattices(tiny), [text] * n, [pieces.key_seed(i, 1)
                                                              for i in range(n)], 3)
    first, second, weighed = collections.Counter(), collections.Counter(), collections.Counter()
    for paths in found:
        keys = [tuple(p[0].tolist()) for p in paths]
        assert len(set(keys)) == 3 and set(keys) <= set(law)
        assert [p[2] for p in paths] == sorted((p[2] for p in paths), reverse=True)
        for key, p in zip(keys, paths):
            assert math.isclose(p[1], math.log(law[key]), abs_tol=1e-9)
            weighed[key] += law[key] / p[3] / n
        first[keys[0]] += 1
        second[keys[1]] += 1
    for key, p in law.items():
        sd = math.sqrt(p * (1 - p) / n)
        assert abs(first[key] / n - p) < 5 * sd + 1e-3
        then = sum(q * p / (1 - q) for other, q in law.items() if other != key)
        assert abs(second[key] / n - then) < 5 * math.sqrt(then / n) + 1e-3
    # inclusion scores: probability over inclusion is unbiased for the whole
    assert abs(sum(weighed.values()) - 1) < 0.1


def test_few_segmentations_are_all_given(tiny):
    law = every_path(tiny, " ab")
    paths = pieces.sample(pieces.Lattices(tiny), ["ab"], [5], 50)[0]
    assert {tuple(p[0].tolist()) for p in paths} == set(law)
    assert all(p[3] == 1.0 for p in paths)


def test_encoding_round_trip(odd, empty):
    found = pieces.sampled(odd, model_file(), keep=("doc_id", "text"))
    back = pieces.decoded(found, model_file(), text="again").select("doc_id", "text", "again", "rank",
                                                                    "ids").collect()
    assert all(r["again"] == (r["text"] or "") for r in back)
    assert {(r["doc_id"], r["text"]) for r in back} == {(r["doc_id"], r["text"])
                                                        for r in odd.collect()}
    long = [tuple(r["ids"]) for r in back if r["doc_id"] == 3]
    assert len(set(long)) == 2
    again = pieces.sampled(odd.repartition(3), model_file(), keep=("doc_id", "text"))
    assert rows_of(again, "doc_id", "rank", "ids") == rows_of(found, "doc_id", "rank", "ids")
    assert pieces.sampled(empty, model_file()).count() == 0


def test_long_unit_without_spaces():
    v = pieces.Vocabulary.load(model_file())
    text = "abcdefgh" * 5000 + "日" * 3000
    for path in pieces.sample(pieces.Lattices(v), [text], [1], 2)[0]:
        assert v.decode(pieces.spelt(v, path[0]).tolist()) == text


# --- language and quality -----------------------------------------------------------------
def test_language_of_odd_texts(odd, empty):
    model = language.fit(odd, F.lit(True))
    named = language.predict(odd.drop("score"), model).collect()
    for r in named:
        blank = not any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == blank and 0 <= r["score"] <= 1
        assert not blank or r["score"] == 0
    nothing = language.fit(empty, F.lit(True))
    assert nothing.names == () and language.predict(empty.drop("score"), nothing).count() == 0
    assert stages.in_a_language(odd).columns == odd.columns
    assert 8 not in {r["doc_id"] for r in stages.in_a_language(odd).collect()}
    assert stages.in_a_language(empty).count() == 0


def test_unlearnt_scripts_go_and_documents_stay(spark):
    df = table(spark, SF, "documents")
    rng = np.random.default_rng(4)
    rows = []
    for low, high in ((0x430, 0x44F), (0x3B1, 0x3C9), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3)):
        for n in (5, 20, 100):
            rows += [(" ".join("".join(map(chr, rng.integers(low, high, rng.integers(2, 9))))
                               for _ in range(n)),) for _ in range(25)]
    strange = spark.createDataFrame(rows, "text string").select(
        (F.monotonically_increasing_id() + (1 << 40)).alias("doc_id"), "text")
    kept = stages.in_a_language(df.unionByName(strange, allowMissingColumns=True)).select("doc_id")
    clean = df.where(F.col("text").rlike("\\p{L}")).select("doc_id")
    assert rows_of(kept, "doc_id") == rows_of(clean, "doc_id")


def test_language_by_brute_force():
    """Vectors bound and bundled letter by letter."""
    first, second, third = language.letter_vectors(64, 7)
    kind = language.letter_classes()
    total = np.zeros(64)
    text = [0] + [int(kind[ord(c)]) for c in "ab cé"] + [0]
    for a, b, c in zip(text, text[1:], text[2:]):
        total += np.roll(third[a], 2) * np.roll(third[b], 1) * third[c]
    assert (language.bundle(["Ab 77 CÉ"], 64, 7)[0] == total).all()


def test_language_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    held = held_out("doc_id", 3, 1)
    model = language.fit(docs, ~held)
    found = language.predict(docs, model).where(held)
    right = found.where("lang = lang_pred").count()
    assert right / found.count() > 0.98


def test_quality_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    held = held_out("doc_id", 4, 2)
    found = quality.scored(docs, labels, ~held).join(labels, "doc_id").where(held).collect()
    good = np.array([r["score"] for r in found if r["quality"] == 1])
    bad = np.array([r["score"] for r in found if r["quality"] == 0])
    assert np.mean([(good > b).mean() for b in bad]) > 0.98
    assert (good >= 0.7).mean() > 0.95 and (bad >= 0.7).mean() < 0.05


def test_quality_of_odd_texts(spark, odd, empty):
    schema = "doc_id bigint, quality int, toxic int"
    labels = spark.createDataFrame([(2, 0, 0), (6, 1, 0), (7, 1, None), (7, 0, 0), (None, 1, 0),
                                    (3, None, 0), (4, 1, 0), (99, 1, 1)], schema)
    none = spark.createDataFrame([], schema)
    good = spark.createDataFrame([(6, 1, 0)], schema)
    for marks in (labels, none, good):
        rows = quality.scored(odd, marks, F.lit(True)).collect()
        assert len(rows) == odd.count()
        assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
        assert quality.scored(empty, marks, F.lit(True)).count() == 0
        assert stages.of_quality(odd, marks).columns == odd.columns
    assert stages.of_quality(odd, none).count() == odd.count()


def test_preference_pairs_order_the_scores():
    rng = np.random.default_rng(2)
    good, bad = rng.normal(1, 1, (300, 3)), rng.normal(0, 1, (100, 3))
    w = quality.bradley_terry(good, bad, pairs=5000)
    gap = good[:100] - bad
    assert (w > 0).all() and ((gap @ w) > 0).mean() > 0.8


# --- one key with most of the rows --------------------------------------------------------
def test_a_language_under_one_id_is_learnt(documents):
    words = {"es": "el perro de la casa y los gatos que corren por las calles",
             "en": "the dog of the house and the cats that run through streets"}
    for key in (77, 78, 80):
        rows = [(key, f"{words['es']} {i}", "es", "s") for i in range(900)]
        rows += [(1000 + i, f"{words['en']} {i}", "en", "s") for i in range(300)]
        chosen = language.sampled(documents(rows), F.lit(True), "text", "lang", "doc_id", 400, 7)
        sizes = {r["lang"]: r["count"] for r in chosen.groupBy("lang").count().collect()}
        assert sizes["en"] == 300 and 250 < sizes["es"] <= 400


def test_equal_rows_are_drawn_one_by_one(documents):
    rows = [(1, "el perro", "es", "s")] * 900
    chosen = language.sampled(documents(rows), F.lit(True), "text", "lang", "doc_id", 400, 7)
    assert 250 < chosen.count() <= 400


def test_labelled_rows_of_one_id_are_bounded(spark):
    rng = np.random.default_rng(3)
    rows = [(5 if i % 3 else i, rng.normal(size=len(quality.FEATURES)).tolist()) for i in range(3000)]
    features = spark.createDataFrame(rows, "doc_id bigint, x array<double>")
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 3000, 3)] + [(5, 1)], "doc_id bigint, quality int")
    seen = []
    original = quality.bradley_terry
    try:
        quality.bradley_terry = lambda good, bad, **more: seen.append(len(good) + len(bad)) or original(good, bad)
        quality.fit(features, labels, F.lit(True), most=300)
    finally:
        quality.bradley_terry = original
    assert 150 < seen[0] <= 300


def test_records_of_one_id_and_text_are_spread(spark, documents):
    """Null ids and texts, different sources: no bucket takes them all."""
    rows = [(None, None, "en", f"source {i}") for i in range(3000)]
    df = documents(rows)
    found = shards.shuffled(df, bucket_bytes=1 << 14).collect()
    assert sorted(r["source"] for r in found) == sorted(r[3] for r in rows)
    for s in range(8):
        assert sorted(r["slot"] for r in found if r["shard"] == s) == list(range(3000 // 8))
    size = shards.text_size("text") + shards.RECORD_BYTES
    record = F.struct(*[F.col(c) for c in df.columns])
    buckets = -(-df.agg(F.sum(size)).first()[0] // (1 << 14))
    at = shards.row_hash(F.col("doc_id").cast("string"), F.xxhash64(record).cast("string"), seed=23) % buckets
    assert df.groupBy(at).count().agg(F.max("count")).first()[0] < 4 * 3000 / buckets


def test_near_duplicates_meet_by_fingerprints(spark):
    """Near copies are found by their SimHash classes where they share no MinHash band; texts that only
    have near fingerprints stay, as the similarity decides."""
    words = [f"w{i}" for i in range(3000)]
    rows = [(1, " ".join(words), "en", "s"), (2, " ".join(words + ["end"]), "en", "s"),
            (3, " ".join(words[::-1]), "en", "s")]
    sets = [minhash.shingles(r[1].encode()) for r in rows]
    fps = [simhash.fingerprint_of(s) for s in sets]
    assert (fps[0] ^ fps[1]).bit_count() <= minhash.BITS_APART
    classes = minhash._alike(spark.createDataFrame(
        [(i, f if f < 1 << 63 else f - (1 << 64)) for i, f in enumerate(fps)], "node bigint, fp bigint"))
    keys = {r["node"]: r["key"] for r in classes.collect()}
    assert keys[0] == keys[1] != keys[2]
    nodes = spark.createDataFrame([(i, [i], 7) for i in range(3)], "node bigint, bands array<bigint>, fp bigint")
    whole = spark.createDataFrame([(i, s.view(np.int64).tolist()) for i, s in enumerate(sets)],
                                  "node bigint, shingles array<bigint>")
    found = minhash.links(nodes, lambda wanted: whole.join(wanted, "node"))
    assert {(r["a"], r["b"]) for r in found.collect()} == {(0, 1)}


def test_few_pairs_of_a_crowd_are_compared(documents, monkeypatch):
    """200 texts that are 0.75 alike, and 30 that are 0.8 like one of them: of the 26,335 pairs hardly more are
    compared than are alike, and none of those is missed."""
    rng = np.random.default_rng(11)
    passage = [f"p{x}" for x in rng.integers(0, 9000, 154)]
    rows = [(i, " ".join(passage + [f"own{i}x{k}" for k in range(25)]), "en", "s") for i in range(200)]
    for i in range(30):
        near = rows[i][1].split()
        for place in (30, 80, 120):
            near[place] = f"edit{i}x{place}"
        rows.append((200 + i, " ".join(near), "en", "s"))
    sets = [set(minhash.shingles(t.encode()).tolist()) for _, t, _, _ in rows]
    assert 0.8 <= len(sets[0] & sets[200]) / len(sets[0] | sets[200]) < 0.86
    assert 0.7 < len(sets[0] & sets[1]) / len(sets[0] | sets[1]) < 0.8
    compared, similar = [], minhash._similar

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return similar(pairs, *rest)

    monkeypatch.setattr(minhash, "_similar", counted)
    kept = {r["doc_id"] for r in stages.without_near_duplicates(documents(rows)).collect()}
    assert kept == set(range(200))
    assert len(compared) == 2 and compared[1] <= 300


def test_parities_differ_in_no_more_bits_than_the_sets():
    rng = np.random.default_rng(12)
    for n, other in ((5, 0), (400, 30), (3000, 3000), (1, 1)):
        a = rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2)
        b = np.append(a[other // 2:], rng.integers(0, 1 << 63, other, np.uint64))
        bits = [minhash.parities(s) for s in (a, b)]
        unlike = sum(int(x).bit_count() for x in (bits[0] ^ bits[1]).view(np.uint64))
        assert len(bits[0]) == minhash.LONGS and unlike <= len(set(a.tolist()) ^ set(b.tolist()))
        assert unlike >= other / 4 or other == 3000


def test_noise_is_drawn_for_all_texts_at_once(tiny, monkeypatch):
    calls, noise = [], pieces.noise

    def counted(*args):
        calls.append(args)
        return noise(*args)

    monkeypatch.setattr(pieces, "noise", counted)
    lat, found = pieces.Lattices(tiny), []
    for texts in (["abcé ab"] * 3, ["abcé ab"] * 300):
        calls.clear()
        found.append(pieces.sample(lat, texts, list(range(len(texts))), 2))
        found.append(len(calls))
    assert max(found[1], found[3]) < 40     # some calls a step of the longest path, none for each text
    for few, many in zip(found[0], found[2]):
        for a, b in zip(few, many):
            assert a[0].tolist() == b[0].tolist() and a[1:] == pytest.approx(b[1:], rel=1e-9)


def test_near_copies_that_met_in_no_group_are_found(spark):
    """Sets at 0.8 that share neither a band nor a class of fingerprints are linked all the same."""
    rng = np.random.default_rng(14)
    sets, want = [], set()
    for i in range(40):
        own = rng.integers(0, 1 << 63, 180 + i)
        gone = len(own) // 9        # of both: 8/9 n over 10/9 n in common
        near = np.append(own[gone:], rng.integers(0, 1 << 63, gone))
        far = np.append(own[gone + 3:], rng.integers(0, 1 << 63, gone + 3))
        same = np.intersect1d(own, near).size
        assert same / (2 * len(own) - same) >= 0.8 > (len(own) - gone - 3) / (len(own) + gone + 3)
        want.add((3 * i, 3 * i + 1))
        sets += [own, near, far]
    nodes = spark.createDataFrame([(i, [1000 + i], int(rng.integers(0, 1 << 62))) for i in range(len(sets))],
                                  "node bigint, bands array<bigint>, fp bigint")
    whole = spark.createDataFrame([(i, sorted(s.tolist())) for i, s in enumerate(sets)],
                                  "node bigint, shingles array<bigint>")
    found = {(r["a"], r["b"]) for r in minhash.links(nodes, lambda wanted: whole.join(wanted, "node")).collect()}
    assert want <= found
    held = [set(s.tolist()) for s in sets]
    assert all(len(held[a] & held[b]) / len(held[a] | held[b]) >= 0.8 for a, b in found)
