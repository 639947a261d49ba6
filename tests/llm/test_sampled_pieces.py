import math
from collections import Counter

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from terrazone.llm import sampled_pieces as sp

LATTICE = sp.Lattice(open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read(), 1.0)


def ways(text):
    """All segmentations of a short text with their weights, by brute force."""
    spelled = {}
    for node in np.flatnonzero(LATTICE.piece >= 0):
        spelled[LATTICE.spelled[LATTICE.piece[node]].decode()] = (int(LATTICE.piece[node]), float(LATTICE.weight[node]))
    def go(at):
        if at == len(text):
            return [((), 0.0)]
        return [((spelled[text[at:e]][0], *rest), spelled[text[at:e]][1] + w) for e in range(at + 1, len(text) + 1) if text[at:e] in spelled for rest, w in go(e)]
    return go(0)


def test_frequencies_follow_the_weights():
    all_ways = ways(" thea")
    total = sum(math.exp(w) for _, w in all_ways)
    n = 40_000
    found = Counter(tuple(x) for x in LATTICE.sample(["thea"] * n, np.arange(n, dtype=np.uint64)))
    assert set(found) <= {p for p, _ in all_ways}
    for pieces, w in all_ways:
        p = math.exp(w) / total
        assert abs(found[pieces] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("abcdehinorst ▁\né梦😀")) | st.characters(exclude_categories=["Cs"]), max_size=60), min_size=1, max_size=4), st.integers(0, 2**63))
def test_decoding_is_lossless(texts, seed):
    ids = LATTICE.sample(texts, np.full(len(texts), seed, np.uint64))
    assert [LATTICE.decode(x) for x in ids] == texts


def test_a_segmentation_depends_on_key_and_text_alone(monkeypatch):
    texts = ["the theory of the thing " * 40, "other words", "", "x" * 3000, "the theory of the thing " * 40]
    seeds = np.array([5, 6, 7, 8, 9], np.uint64)
    want = [x.tolist() for x in LATTICE.sample(texts, seeds)]
    assert want[0] != want[4]
    assert [LATTICE.sample([t], seeds[i:i + 1])[0].tolist() for i, t in enumerate(texts)] == want
    monkeypatch.setattr(sp, "CHUNK", 50)
    assert [x.tolist() for x in LATTICE.sample(texts, seeds)] == want


def test_rows(spark):
    df = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, "a b", 1), (3, "▁ \U0001F600", 1), (4, "the end", 1), (4, "the end", 1)], "doc_id long, text string, pieces int")
    cut = sp.encode(df, lossless="lossless")
    rows = cut.collect()
    assert all(r["lossless"] for r in rows) and len(rows) == 6
    assert [len(r["pieces"]) for r in rows if not r["text"]] == [0, 0]
    assert len({tuple(r["pieces"]) for r in rows if r["doc_id"] == 4}) == 1
    back = sp.decode(cut).select("text", "decoded").collect()
    assert all(r["decoded"] == (r["text"] or "") for r in back)
    again = {(r["doc_id"], tuple(r["pieces"])) for r in sp.encode(df.repartition(1)).collect()}
    assert again == {(r["doc_id"], tuple(r["pieces"])) for r in rows}
    other = sp.encode(df.where("doc_id = 4"), seed=9).select(F.xxhash64("pieces")).distinct()
    assert other.count() == 1
    assert sp.encode(df.limit(0)).collect() == []
