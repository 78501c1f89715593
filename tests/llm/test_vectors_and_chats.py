"""Vector searches against brute force; transcripts against known roles; the registered queries."""

import itertools
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from compare import connect, difference
from tidemart.llm import collision, hamming, transcripts
from tidemart.llm.queries import QUERIES
from tidemart.llm.shared import table

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "vec_id bigint, embedding array<float>, label int, v string, score string, code string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, 0, "v", "s", "c") for i, v in rows], SCHEMA)


@pytest.fixture
def odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=8) * rng.uniform(0.1, 3)).tolist()) for i in range(200)]
    rows += [(i, rows[3][1]) for i in range(200, 240)]              # ties
    rows += [(240, None), (260, []), (280, [0.0] * 8), (300, [None] + [1.0] * 7),
             (320, [float("nan")] + [1.0] * 7), (340, [float("inf")] + [1.0] * 7),
             (None, [1.0] * 8), (7, rows[7][1]), (360, [1.0, 2.0]), (380, [2.0, 1.0])]
    return vectors_of(spark, rows), rows


def sound(rows):
    """(id, vector) of every row that takes part, repeated ones too."""
    out = []
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        out.append((i, np.array(v, np.float32).astype(float)))
    return out


def test_nearest_by_inner_product(odd_vectors):
    df, rows = odd_vectors
    known = sound(rows)
    found = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in collision.near(
        df, k=20, every=20, block=64, chunk=5).collect())
    hits = total = 0
    for q, (own, vector) in enumerate(known):
        if own % 20:
            continue
        assert sum(i == own for i, _ in known) == 1     # of the queries
        got = [(i, s) for x, _, i, s in found if x == own]
        others = [(i, float(np.dot(v, vector))) for n, (i, v) in enumerate(known)
                  if n != q and len(v) == len(vector)]
        want = sorted(others, key=lambda x: (-round(x[1], 9), x[0]))[:20]
        hits += len({i for i, _ in got} & {i for i, _ in want})
        total += len(want)
        assert len(got) == len(want)
        scores = {(i, round(s, 9)) for i, s in others}
        assert all((i, round(s, 9)) in scores for i, s in got)
        assert got == sorted(got, key=lambda x: (-x[1], x[0]))
    assert hits / total >= 0.9


def test_rows_that_share_an_id_are_all_searched(spark):
    df = vectors_of(spark, [(1, [0.1, 0.1]), (1, [5.0, 5.0]), (0, [1.0, 0.0]), (0, [0.0, 2.0]),
                            (7, [1.0, 1.0]), (7, [1.0, 1.0])])
    got = sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 6)) for r in collision.near(df).collect())
    first = [(0, 1, 1, 5.0), (0, 2, 7, 1.0), (0, 3, 7, 1.0), (0, 4, 1, 0.1), (0, 5, 0, 0.0)]
    second = [(0, 1, 1, 10.0), (0, 2, 7, 2.0), (0, 3, 7, 2.0), (0, 4, 1, 0.2), (0, 5, 0, 0.0)]
    assert got == sorted(first + second)
    codes = hamming.similar_signs(df).collect()
    assert len(codes) == 10 and sorted(r["distance"] for r in codes if r["vec_id"] == 0) == [2, 2]


def test_a_third_of_the_rows_under_one_id(spark):
    rng = np.random.default_rng(6)
    rows = [(3 if i % 3 else i, rng.normal(size=6).tolist()) for i in range(600)]
    df = vectors_of(spark, rows)
    known = sound(rows)
    got = collision.near(df, k=5, every=50, block=64, chunk=4).collect()
    queries = [(i, v) for i, v in known if i % 50 == 0]
    assert len(got) == 5 * len(queries)
    hits = 0
    for own, vector in queries:
        want = sorted((-float(v @ vector), i) for i, v in known if v is not vector)[:5]
        hits += len({round(-s, 6) for s, _ in want} & {round(r["score"], 6) for r in got if r["query_id"] == own})
    assert hits / len(got) >= 0.9
    signs = hamming.similar_signs(df, k=5, every=50).collect()
    for own, vector in queries:
        want = sorted((int(((v > 0) != (vector > 0)).sum()), i) for i, v in known if v is not vector)[:5]
        assert sorted((r["distance"], r["vec_id"]) for r in signs if r["query_id"] == own) == want


@pytest.mark.parametrize("size", [65, 128, 200])
def test_codes_are_as_wide_as_the_vectors(spark, size):
    """Vectors that differ in their last components only."""
    rng = np.random.default_rng(size)
    rows = [(i, [1.0] * 64 + rng.normal(size=size - 64).tolist()) for i in range(120)]
    df = vectors_of(spark, rows)
    found = hamming.similar_signs(df, k=4, every=20).collect()
    bits = {i: np.array(v) > 0 for i, v in rows}
    assert len(found) == 6 * 4
    for q in range(0, 120, 20):
        want = sorted((int((bits[q] != b).sum()), i) for i, b in bits.items() if i != q)[:4]
        assert sorted((r["distance"], r["vec_id"]) for r in found if r["query_id"] == q) == want


def test_recall_on_the_tables(spark):
    df = table(spark, "/root/testdata/sf0.01", "embeddings")
    rows = df.collect()
    ids = np.array([r["vec_id"] for r in rows])
    x = np.array([r["embedding"] for r in rows], np.float64)
    found = {}
    for r in collision.near(df).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = []
    for q in ids[ids % 20 == 0]:
        s = x @ x[ids == q][0]
        s[ids == q] = -np.inf
        hits.append(len(found[q] & set(ids[np.lexsort((ids, -s))[:20]].tolist())) / 20)
    assert np.mean(hits) >= 0.9


def test_hamming_is_exact(spark):
    rng = np.random.default_rng(8)
    centre = int(rng.integers(0, 1 << 62))
    codes = [int(rng.integers(0, 1 << 62)) for _ in range(300)] + [centre] * 60
    codes += [centre ^ (1 << int(rng.integers(0, 60))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(codes)), "vec_id bigint, code bigint")
    found = {}
    for r in hamming.top_k(df, df.where("vec_id % 10 = 0"), 10, block=100, chunk=7).collect():
        found.setdefault(r["query_id"], []).append((r["distance"], r["vec_id"], r["rank"]))
    for q, got in found.items():
        want = sorted(((codes[q] ^ c).bit_count(), i) for i, c in enumerate(codes) if i != q)[:10]
        assert sorted(got) == [(d, i, n) for n, (d, i) in enumerate(want, 1)]
    assert len(found) == len(codes) / 10


def test_hamming_of_odd_vectors(odd_vectors):
    df, rows = odd_vectors
    known = sound(rows)
    found = hamming.similar_signs(df, k=5, every=20).collect()
    bits = [(i, [bool(x > 0) for x in v] + [False] * (64 - len(v))) for i, v in known]
    for q in {r["query_id"] for r in found}:
        own = dict(bits)[q]
        want = sorted((sum(map(bool.__ne__, own, b)), i) for i, b in bits if i != q)[:5]
        assert sorted((r["distance"], r["vec_id"]) for r in found if r["query_id"] == q) == want
    assert len({r["query_id"] for r in found}) == sum(i % 20 == 0 for i, _ in known)


def test_searches_of_nothing(spark):
    none = vectors_of(spark, [])
    assert collision.near(none).count() == hamming.similar_signs(none).count() == 0
    one = vectors_of(spark, [(0, [1.0, 2.0])])
    assert collision.near(one).count() == hamming.similar_signs(one).count() == 0


# --- transcripts -----------------------------------------------------------------------
CHATS = "conv_id bigint, turn bigint, role string, text string, group string, conv string"


def chats_of(spark, rows):
    return spark.createDataFrame([(*r, "g", "c") for r in rows], CHATS)


def test_roles_are_recovered(spark):
    chats = table(spark, "/root/testdata/sf0.01", "conversations")
    raw = transcripts.as_transcript(chats)
    found = transcripts.parse(raw, transcripts.fit(raw)).where("part = 0").alias("f")
    right = found.join(chats.alias("c"), ["conv_id", "turn"]).where("f.role = c.role").count()
    assert found.count() == chats.count() and right / chats.count() > 0.97


@pytest.mark.parametrize("together, fan", [(64, 64), (8, 2)])
def test_pieces_of_a_transcript_are_solved_as_one(spark, monkeypatch, together, fan):
    """A long transcript, spread over a tree of groups, equals Viterbi over all its lines."""
    monkeypatch.setattr(transcripts, "ROWS_TOGETHER", together)
    monkeypatch.setattr(transcripts, "FAN", fan)
    rng = np.random.default_rng(4)
    rows = [(1, i, r, t) for i, (r, t) in enumerate(itertools.islice(itertools.cycle([
        ("user", "Why is it?"), ("assistant", "Because it is so, in all likelihood."),
        ("user", "And?"), ("assistant", "User: nested\nmore\nAI: yes")]), 400))]
    raw = chats_of(spark, [(c, i, r, f"{r}: {t}" if rng.random() < 0.3 else t)
                           for c, i, r, t in rows])
    model = transcripts.fit(raw)
    texts = [r["text"] for r in raw.orderBy("turn").collect()]
    lines = transcripts.lines_of(model, texts)
    want = transcripts.turns(model.roles, lines, transcripts.viterbi(model, lines, None, None))
    found = transcripts.parse(raw, model).orderBy("turn", "part").collect()
    assert [(r["turn"], r["part"], r["role"], r["text"]) for r in found] == want
    assert found[0]["rendered"] == f"<|{found[0]['role']}|>\n{found[0]['text']}\n<|end|>"


def test_best_path_by_listing_all():
    roles = ("a", "b")
    rng = np.random.default_rng(6)
    step = np.log(np.array([[0.7, 0.3], [0.4, 0.6]]))
    model = transcripts.RoleModel(roles, np.log([0.6, 0.4]), step, {}, {}, (0.0, 0.0))
    lines = [transcripts.Line(i, "", i % 3 != 1, rng.normal(size=2)) for i in range(8)]

    def weight(path):
        total = model.start[path[0]] + lines[0].score[path[0]]
        for i in range(1, len(path)):
            if lines[i].boundary:
                total += step[path[i - 1], path[i]]
            elif path[i] != path[i - 1]:
                return -np.inf
            total += lines[i].score[path[i]]
        return total
    best = max(itertools.product(range(2), repeat=8), key=weight)
    assert transcripts.viterbi(model, lines, None, None) == list(best)


def test_odd_transcripts(spark):
    raw = chats_of(spark, [(None, None, None, None), (1, None, "user", ""), (1, 0, "user", "Q: hi"),
                           (1, 0, "user", "Q: hi"), (2, 5, None, "```\nuser: code\n```\nAI: ok"),
                           (3, -7, "tool", "x" * 300_000), (3, 1 << 40, "system", "\n\n")])
    model = transcripts.fit(raw)
    found = transcripts.parse(raw, model).collect()
    assert sum(r["part"] == 0 for r in found) == 7 and {r["role"] for r in found} <= set(model.roles)
    none = chats_of(spark, [])
    assert transcripts.parse(none, transcripts.fit(none)).count() == 0


def test_rows_of_one_turn_are_spread_over_groups(spark):
    raw = chats_of(spark, [(1, None, None, "Q: why")] * 300 + [(1, 3, "user", "A: so")] * 300
                   + [(None, 1, "user", "hm")] * 100)
    groups = transcripts.placed_in_order(raw, "conv_id", "turn", "text").groupBy("conv", "group")
    sizes = [r["count"] for r in groups.count().collect()]
    assert sum(sizes) == 700 and max(sizes) <= transcripts.ROWS_TOGETHER
    found = transcripts.parse(raw, transcripts.fit(raw))
    assert found.where("part = 0").count() == 700


# --- registered queries ------------------------------------------------------------------
def test_every_operator_is_registered():
    numbers = [int(name[2:].split("_")[0]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14)) and {*QUERIES, "pipeline"} <= set(queries())


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(oracle_sql())))
def test_query_equals_sql(spark, name):
    assert difference(queries()[name](spark, SF_DIR), connect(SF_DIR), oracle_sql()[name]) is None


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_pipeline(spark):
    docs = table(spark, SF_DIR, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF_DIR)
        assert after.columns == docs.columns, name
        docs = after
    kept = {r["doc_id"]: r["count"] for r in docs.groupBy("doc_id").count().collect()}
    rows = corpus_pipeline.run(spark, SF_DIR).where("rank = 1").groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in rows} == kept and max(kept.values()) <= 2
    low = table(spark, SF_DIR, "labels").where("quality = 0").select("doc_id")
    assert docs.join(low, "doc_id", "left_semi").count() <= 0.05 * max(1, low.count())


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_of_nothing(spark, empty, name, stage):
    assert stage(spark, empty, SF_DIR).count() == 0


def test_native_operators_run_no_python(spark, odd):
    from tidemart.llm import licenses, mixing, shards
    for df in (licenses.scan(odd), mixing.mix(odd), mixing.mixed(odd), shards.shuffled(odd)):
        plan = df._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "CartesianProduct"))
        assert F is not None
