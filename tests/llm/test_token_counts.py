"""Token counts against the library itself, on whole texts."""

import pytest
from tokenizers import Tokenizer

from tidemart.llm import token_counts
from tidemart.llm.queries import model_file
from tidemart.llm.shared import table

FILE = model_file("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(FILE)
ODD = [
    None, "", " ", "a", "<|startoftext|>Hi<|endoftext|>", "<|STARTOFTEXT|>x", "It's THE 12345 don't'll",
    "日本語　テキスト", "é ́́ x ́", "x" * 5000, "<|endoftext|>" * 3,
    "a\x00b\tc　d e\x85f\x1cg\x0bh", "ΑΣ ΟΔΟΣ İstanbul ß", "'s's 'll", "🙂👍🏽 ‍﻿",
    "a. b.c, 3.14.15 e.g.'s x.... (y). Z!?! a.\u0301 A\u0301. \u212a. \u1e96 H\u0331 h\u0331 \u00df. \u0130.",
    "<|EndOfText|> x<|endoftext|>,y <|ENDOFTEXT|><|endoftext|> 's.'S.'re,'RE don't.I'M. a's.b'S",
    "word " * 60_000, "x\n\n \n y " * 3000, " <|endoftext|> z", "=== ---- (((", "ﬁ ½ Å 한"]


def plain(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("frequent", [0, 3, token_counts.FREQUENT])
def test_counts_are_those_of_the_library(spark, documents, frequent):
    made = documents([(i, t, "en", "s") for i, t in enumerate(ODD)])
    got = {r["doc_id"]: tuple(r)[1:] for r in token_counts.counted(made, FILE, frequent=frequent).collect()}
    for i, t in enumerate(ODD):
        n = plain(t)
        assert got[i] == (len((t or "").encode()), n, n > 2048), repr(t)[:60]


def test_counts_of_odd_rows(odd, empty):
    got = token_counts.counted(odd, FILE, keep=("doc_id", "text", "size", "x")).collect()
    assert len(got) == odd.count()
    assert all(r["n_tokens"] == plain(r["text"]) for r in got)
    assert token_counts.counted(empty, FILE).collect() == []


def test_counts_of_a_whole_table(spark):
    rows = table(spark, "/root/testdata/sf0.001", "documents")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.counted(rows, FILE).collect()}
    assert got == {r["doc_id"]: plain(r["text"]) for r in rows.collect()}


def test_tokenizers_that_keep_white_space_are_refused(documents):
    with pytest.raises(ValueError, match="white space"):
        token_counts.counted(documents([]), model_file("byte_bpe_50k.json"))
