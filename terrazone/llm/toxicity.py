"""Toxicity from the nearest labelled examples by exact TF-IDF cosine over a block-max inverted index.

Terms are the words of the labelled documents, each under its own number; their document frequencies are counted over all documents. A
word of no labelled document has no example to point to and no place in the vectors; one of a single document can match no other and
weighs nothing. No other word is left out, however rare. The index holds a bounded number of labelled examples of each class. Each of its blocks of similar examples
has, per term, the largest weight in it: the sum over a text's terms bounds the cosine with all examples of the block, so
that blocks are opened from the highest bound down until no bound reaches the k-th best cosine. Votes of the neighbours, weighted by
cosine, and the mean cosines with the nearest of either class are the features of boosted trees, fitted on other labelled documents,
which turn them into a calibrated score.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from . import boosting

#: Hashed terms, where there is no vocabulary; the power of the inverse document frequency.
TERMS, POWER = 1 << 18, 1.5
#: Labelled documents of each class in the index at most; of each class for calibration at most.
EXAMPLES, CALIBRATION = 1000, (800, 4000)
#: Neighbours of each class that are looked for; examples in a block.
NEIGHBOURS, BLOCK = 500, 32
WORD = re.compile(r"\w+")


def words_of(text: str | None) -> set[str]:
    """The distinct words of a whole text."""
    return set(WORD.findall(text.lower())) if text else set()


def terms(text: str | None) -> np.ndarray:
    """The distinct hashed words of a whole text."""
    words = words_of(text)
    return np.unique(np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) & (TERMS - 1) for w in words), np.int64, len(words)))


class Vocabulary:
    """Known words by number."""

    def __init__(self, words: Iterable[str]):
        self.number = {w: i for i, w in enumerate(sorted(words))}

    def terms(self, text: str | None) -> np.ndarray:
        """The numbers of the distinct known words of a whole text."""
        return np.array(sorted(self.number[w] for w in words_of(text) if w in self.number), np.int64)


def document_frequencies(df: DataFrame, text: str, vocabulary: Vocabulary | None = None) -> tuple[np.ndarray, int]:
    """In how many of all documents each known word occurs, or each hashed term without a vocabulary, and the number of documents.

    Each task adds up its own documents first.
    """
    size = TERMS if vocabulary is None else len(vocabulary.number)
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, rows, of = np.zeros(size, np.int64), 0, shared.value.terms if shared.value else terms
        for batch in batches:
            rows += len(batch)
            for t in batch["text"]:
                total[of(t)] += 1
        there = np.flatnonzero(total)
        yield pd.DataFrame({"term": np.r_[-1, there], "n": np.r_[rows, total[there]]})

    table = df.select(F.col(text).alias("text")).mapInPandas(counted, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    shared.unpersist()
    out = np.zeros(size + 1, np.int64)
    out[table["term"].to_numpy(np.int64)] = table["n"].to_numpy(np.int64)  # term -1 is the last place
    return out[:-1], int(out[-1])


class Index:
    """An inverted index of examples of several classes, in blocks of similar examples of one class.

    The postings of a term are the numbers and weights of the examples that have it. ``best[t, b]`` is the largest weight of term t in block b.
    Only terms of examples have columns; the others count for the length of a vector.
    """

    def __init__(self, classes: list[list[np.ndarray]], weight: np.ndarray):
        self.weight = weight
        there = np.zeros(len(weight), bool)
        for e in (e for examples in classes for e in examples):
            there[e] = True
        kept = np.flatnonzero(there & (weight > 0))
        self.column = np.full(len(weight), -1)
        self.column[kept] = np.arange(len(kept))
        self.order, self.blocks, vectors, at = [], [], [], 0
        for examples in classes:
            own = [self.vector(e) for e in examples]
            order = similar_first(own)
            self.order.append(order)
            vectors += [(at + i, *own[k]) for i, k in enumerate(order)]
            n = -(-len(own) // BLOCK)
            self.blocks.append(slice(at // BLOCK, at // BLOCK + n))
            at += n * BLOCK
        self.size = at
        terms_of = np.concatenate([c for _, c, _ in vectors]) if vectors else np.zeros(0, np.int64)
        by_term = np.argsort(terms_of, kind="stable")
        self.example = np.repeat([i for i, _, _ in vectors], [len(c) for _, c, _ in vectors]).astype(np.int64)[by_term]
        self.value = (np.concatenate([w for _, _, w in vectors]) if vectors else np.zeros(0))[by_term]
        self.start = np.searchsorted(terms_of[by_term], np.arange(len(kept) + 1))
        self.best = np.zeros((len(kept), at // BLOCK), np.float32)
        np.maximum.at(self.best, (terms_of[by_term], self.example // BLOCK), self.value.astype(np.float32))

    def vector(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Columns and weights of a document, of unit length over all its terms."""
        w, column = self.weight[found], self.column[found]
        w = w / (np.sqrt((w * w).sum()) or 1.0)
        return column[column >= 0], w[column >= 0]

    def nearest(self, columns: np.ndarray, w: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each class the k examples of the largest cosine, largest first; exact.

        The blocks of the highest bounds that hold k examples are opened first; then those whose bound reaches the k-th best cosine found there.
        """
        if not len(columns):
            return [(np.zeros(0, np.int64), np.zeros(0)) for _ in self.blocks]
        bound = (w.astype(np.float32) @ self.best[columns]) * (1 + 1e-6 + 1e-7 * len(w)) + 1e-6  # never below, also as rounded
        counts = self.start[columns + 1] - self.start[columns]
        ends = np.cumsum(counts)
        at = np.arange(ends[-1]) + np.repeat(self.start[columns] - ends + counts, counts)
        example, part = self.example[at], self.value[at] * np.repeat(w, counts)
        opened = np.zeros(len(bound), bool)
        for own in self.blocks:
            opened[own.start + np.argsort(-bound[own], kind="stable")[:-(-k // BLOCK) + 1]] = True
        now = opened[example // BLOCK]
        scores = np.bincount(example[now], part[now], self.size)
        more = np.zeros(len(bound), bool)
        for own, order in zip(self.blocks, self.order):
            if len(order) > k:
                mine = scores[own.start * BLOCK:own.start * BLOCK + len(order)]
                more[own] = bound[own] >= np.partition(mine, len(mine) - k)[len(mine) - k]
            else:
                more[own] = True
        rest = (more & ~opened)[example // BLOCK]
        scores += np.bincount(example[rest], part[rest], self.size)
        out = []
        for own, order in zip(self.blocks, self.order):
            mine = scores[own.start * BLOCK:own.start * BLOCK + len(order)]
            top = np.argpartition(-mine, k - 1)[:k] if len(mine) > k else np.arange(len(mine))
            top = top[np.lexsort((order[top], -mine[top]))]
            out.append((order[top], mine[top]))
        return out


def similar_first(vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Examples ordered so that those sharing common terms stand together: by their commonest terms."""
    if not vectors:
        return np.zeros(0, np.int64)
    df = np.bincount(np.concatenate([c for c, _ in vectors]))
    key = [sorted(c.tolist(), key=lambda t: (-df[t], t))[:6] for c, _ in vectors]
    return np.array(sorted(range(len(vectors)), key=lambda i: (key[i], i)), np.int64)


@dataclass
class Neighbours:
    vocabulary: Vocabulary
    index: Index
    toxic_ids: list
    clean_ids: list
    trees: boosting.Boosted | None
    prior: float

    def look(self, found: np.ndarray, own: tuple[int, int] | None = None) -> tuple[list[float], list[tuple[int, float, int]]]:
        """Features of a document, and its three nearest examples as (key, cosine, label). ``own`` names an example (label, number) that is left out: the document itself."""
        (ti, tc), (ci, cc) = self.index.nearest(*self.index.vector(found), NEIGHBOURS)
        if own and own[0] == 1:
            ti, tc = ti[ti != own[1]], tc[ti != own[1]]
        elif own:
            ci, cc = ci[ci != own[1]], cc[ci != own[1]]
        cosines, label = np.concatenate([tc, cc]), np.r_[np.ones(len(tc)), np.zeros(len(cc))]
        order = np.argsort(-cosines, kind="stable")
        cosines, label = cosines[order], label[order]
        votes = [float(cosines[:k] @ label[:k] / (cosines[:k].sum() or 1.0)) for k in (15, 40, 100)]
        means = [(tc[:k].mean() if len(tc) else 0.0, cc[:k].mean() if len(cc) else 0.0) for k in (20, 100, 250, NEIGHBOURS)]
        features = votes + [a - b for a, b in means] + [float(np.log((a + 1e-3) / (b + 1e-3))) for a, b in means]
        names = np.r_[ti, ci][order[:3]]
        return features, [((self.toxic_ids if y else self.clean_ids)[i], float(c), int(y)) for i, c, y in zip(names, cosines, label[:3])]

    def score(self, features: list[list[float]], empty: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(features), self.prior)
        return np.where(empty, self.prior, self.trees.score(np.array(features).reshape(len(features), -1)))


def labelled(df: DataFrame, labels: DataFrame, key: str, label: str, text: str) -> tuple[pd.DataFrame, Vocabulary]:
    """Keys, labels and numbers of the words of a bounded number of labelled documents of each class, those of the smallest hash of their key.

    Only their keys are broadcast. Labels that differ for one key count as toxic; of repeated documents the smallest text counts.
    """
    each = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(key).cast("long").alias("key")).agg(F.max(label).alias("y"))
    hashed = each.withColumn("h", F.xxhash64("key"))
    chosen = [hashed.where(F.col("y") == y).orderBy("h", "key").limit(EXAMPLES + CALIBRATION[1 - y]) for y in (1, 0)]
    texts = df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen[0].unionByName(chosen[1])), "key")
    once = texts.groupBy("key", "y", "h").agg(F.min("text").alias("text"))

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"key": b["key"], "y": b["y"], "h": b["h"], "words": [sorted(words_of(t)) for t in b["text"]]})

    table = once.mapInPandas(found, "key long, y int, h long, words array<string>").toArrow()
    table = table.take(pc.sort_indices(table, [("h", "ascending"), ("key", "ascending")])).combine_chunks()
    coded = pc.dictionary_encode(pc.list_flatten(table["words"])).combine_chunks()  # each word becomes one string of Python
    words = coded.dictionary.to_pylist() if len(coded) else []
    vocabulary = Vocabulary(words)
    number = np.array([vocabulary.number[w] for w in words], np.int64)[coded.indices.to_numpy()] if words else np.zeros(0, np.int64)
    ends = np.cumsum(pc.list_value_length(table["words"]).to_numpy())
    out = table.select(["key", "y"]).to_pandas()
    out["terms"] = pd.Series([np.sort(t) for t in np.split(number, ends)[:len(out)]], dtype=object)
    return out, vocabulary


def fit(df: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "toxic", text: str = "text") -> Neighbours:
    """Index and calibration from labelled documents; frequencies of their words from all documents.

    The first labelled documents of each class are the index. Calibration learns from these, each without itself among its neighbours, and from the others.
    Without two labelled documents of both classes every score is the share of toxic ones (0.1 without any).
    """
    table, vocabulary = labelled(df, labels, key, label, text)
    df_count, rows = document_frequencies(df, text, vocabulary)
    weight = np.where(df_count >= 2, np.log((rows + 1) / (df_count + 1)) ** POWER, 0.0)
    keep = weight > 0
    vocabulary, weight, number = Vocabulary(w for w, i in vocabulary.number.items() if keep[i]), weight[keep], np.cumsum(keep) - 1
    classes = {y: table[table["y"] == y] for y in (1, 0)}
    found = {y: [number[t[keep[t]]] for t in classes[y]["terms"]] for y in classes}
    prior = float((table["y"] == 1).mean()) if len(table) else 0.1
    index = Index([found[y][:EXAMPLES] for y in (1, 0)], weight)
    model = Neighbours(vocabulary, index, classes[1]["key"].tolist()[:EXAMPLES], classes[0]["key"].tolist()[:EXAMPLES], None, prior)
    if min(map(len, found.values())) > 1:
        x = [model.look(t, (y, i) if i < EXAMPLES else None)[0] for y in (1, 0) for i, t in enumerate(found[y])]
        model.trees = boosting.fit(np.array(x), np.repeat([1.0, 0.0], [len(found[1]), len(found[0])]))
    return model


def score(df: DataFrame, model: Neighbours, text: str = "text", name: str = "toxicity") -> DataFrame:
    """Add (score, evidence) of each whole text; evidence lists the three nearest examples as (key, cosine, label).

    A null or empty text, or one without a word of an example, has the share of toxic examples as its score and no evidence. Rows are
    independent: repeated rows get equal scores, an empty table stays empty, other columns pass through, a column already
    called ``name`` is replaced. One pass without a shuffle.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<score:double,evidence:array<struct<key:long,cosine:double,label:int>>>")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            looked = [m.look(m.vocabulary.terms(t)) for t in texts]
            values = m.score([f for f, _ in looked], np.array([not e for _, e in looked], bool)) if looked else np.zeros(0)
            yield pd.DataFrame({"score": values, "evidence": [[{"key": k, "cosine": c, "label": y} for k, c, y in e] for _, e in looked]})

    return df.withColumn(name, scored(F.col(text)))
