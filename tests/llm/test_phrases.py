"""Phrases from indexes of shards against counting all runs of words."""

import collections
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from tidemart.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, shortest=2, longest=3, least=10, share=50, top=2000):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in f.items():
        found, known = [], {p: a for p, a in own.items() if a >= least}
        left, right = collections.defaultdict(int), collections.defaultdict(int)
        for p, a in known.items():
            if len(p) > 1:
                left[p[1:]] = max(left[p[1:]], a)
                right[p[:-1]] = max(right[p[:-1]], a)
        for p, a in known.items():
            if len(p) < shortest or 100 * max(left[p], right[p]) >= share * a:
                continue
            score, _, l, r = min((1000000 * a * a // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]])
                                 for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r, left[p] or None, right[p] or None))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s, ml, mr)
                for i, (s, a, p, l, r, ml, mr) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=repr)


def found(df, **more):
    return sorted((tuple(r) for r in phrases.collocations(df, **more).collect()), key=repr)


@pytest.fixture
def rows():
    rng = np.random.default_rng(3)
    words = np.array(["a", "B", "cc", "d'e", "é", "日本", "x\x01y", "the", "of"])
    made = []
    for i in range(200):
        text = "".join(words[rng.integers(len(words))] + [" ", "  ", "\t", ". ", ",", "\n", " "][rng.integers(7)]
                       for _ in range(rng.integers(0, 60)))
        made.append((i, text, [None, "en", "de", ""][i % 4], "s"))
    made += [(900, "a a a a a a a a a a a a a a", "en", "s"), (901, "new york city " * 50, "en", "s"),
             (902, None, "en", "s"), (903, "", "fr", "s"), (904, " \t\n.,;", "fr", "s"),
             (905, "of the " * 5000, "de", "s"), (905, "of the " * 5000, "de", "s")]
    return made


@pytest.mark.parametrize("words", [40, 5000, phrases.WORDS])
def test_phrases_equal_counting(documents, rows, words):
    assert found(documents(rows), words=words) == plain(rows)


def test_phrases_of_other_lengths(documents, rows):
    for more in ({"longest": 4, "least": 5}, {"longest": 2, "top": 3}, {"shortest": 3, "longest": 5, "least": 3,
                 "share": 101}):
        assert found(documents(rows), words=300, **more) == plain(rows, **more)


def test_a_full_set_drops_nothing(documents, rows, monkeypatch):
    monkeypatch.setattr(phrases, "MOST_BITS", 8)
    monkeypatch.setattr(phrases, "BITS_EACH", 0)
    monkeypatch.setattr(phrases.Frequent, "holds", lambda self, hashes, length: np.ones(len(hashes), bool))
    assert found(documents(rows), words=700) == plain(rows)


def test_hashes_agree_with_spark(spark):
    from pyspark.sql import functions as F
    import xxhash
    known = ["", "a", "日本", "x\x01y"]
    hashes = np.array([xxhash.xxh64_intdigest(w.encode(), 42) for w in known], np.uint64)
    ids = np.array([[1, 2, 3], [3, 3, 1]])
    own = phrases.phrase_hashes("en", ids, hashes).astype(np.int64).tolist()
    df = spark.createDataFrame([(i, " ".join(known[j] for j in w)) for i, w in enumerate(ids)], "i int, p string")
    assert [r[0] for r in df.orderBy("i").select(phrases.phrase_hash(F.lit("en"), F.col("p"))).collect()] == own


def test_intervals_count_every_phrase_in_both_directions():
    rng = np.random.default_rng(4)
    ids = np.where(rng.random(3000) < 0.1, 0, rng.integers(1, 8, 3000))
    ids[0] = ids[-1] = 0
    sides = [phrases.Index(phrases.before_each(x, 4)) for x in (ids, ids[::-1])]
    now = phrases.Intervals.single(sides[0], 7)
    for length in range(2, 5):
        now = now.extended(sides[0]) if length % 2 else now.turned().extended(sides[1]).turned()
        runs = np.lib.stride_tricks.sliding_window_view(ids, length)
        want = collections.Counter(map(tuple, runs[(runs > 0).all(1)].tolist()))
        assert {tuple(w): n for w, n in zip(now.words.tolist(), now.n.tolist())} == want


def test_phrases_of_odd_rows(odd, empty, documents):
    assert found(empty) == []
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in odd.collect()]
    assert found(odd, least=1, share=200) == plain(rows, least=1, share=200)


def test_shards_are_written_and_read_one_at_a_time(documents, rows, monkeypatch):
    """A task's shards stand in row groups of their own, however many it makes."""
    groups, saved = [], phrases.saved

    def noted(df, name, *args, **more):
        out = saved(df, name, *args, **more)
        if name == "shards":
            for path in out.inputFiles():
                meta = pq.ParquetFile(path.removeprefix("file://")).metadata
                groups.append([meta.row_group(i).num_rows for i in range(meta.num_row_groups)])
        return out

    monkeypatch.setattr(phrases, "saved", noted)
    assert found(documents(rows).coalesce(1), words=100) == plain(rows)
    assert sum(map(sum, groups)) > 20 and {n for g in groups for n in g} == {1}
