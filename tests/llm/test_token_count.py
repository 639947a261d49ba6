import random

import public_tokenizers
import sentencepiece
from hypothesis import given, settings, strategies as st

from terrazone.llm import token_count as tc

MODEL = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
RANKS = tc.PairRanks(MODEL)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("abcdehinorst <>/0x▁\n\té梦😀=.")) | st.characters(exclude_categories=["Cs"]), max_size=80), max_size=5))
def test_counts_are_those_of_the_library(texts):
    assert RANKS.count(texts) == [len(x) for x in LIBRARY.encode(texts)]


def test_long_runs_and_special_strings():
    rng = random.Random(1)
    texts = ["a" * 5000, "=" * 3001, " " * 999, "ab" * 4000, "▁ " * 77, "<s></s><unk><0x0A>", "".join(rng.choice("ABCDEFabcdef0123456789+/") for _ in range(20000)),
             "".join(rng.choice("theraneding") for _ in range(3000))]
    assert RANKS.count(texts) == [len(x) for x in LIBRARY.encode(texts)]


def test_chunks_change_nothing(monkeypatch):
    texts = [" a  b   c" * 50, "word " * 300]
    want = RANKS.count(texts)
    monkeypatch.setattr(tc, "CHUNK", 16)
    assert RANKS.count(texts) == want
    assert all("".join(tc.chunks(t, 7)) == t for t in texts)


def test_a_full_memory_is_emptied(monkeypatch):
    monkeypatch.setattr(tc, "REMEMBERED", 3)
    ranks = tc.PairRanks(MODEL)
    assert ranks.count(["one two three four", "five six one two"]) == [len(x) for x in LIBRARY.encode(["one two three four", "five six one two"])]


def test_rows(spark):
    df = spark.createDataFrame([(1, None, 7), (2, "", 7), (3, "hello world", 7), (3, "hello world", 7)], "doc_id long, text string, n_tokens int")
    rows = sorted(tuple(r) for r in tc.count_tokens(df).select("doc_id", "n_tokens").collect())
    n = len(LIBRARY.encode("hello world"))
    assert rows == [(1, 0), (2, 0), (3, n), (3, n)]
    assert tc.count_tokens(df.limit(0)).collect() == []
