"""Sampled segmentation into pieces by forward filtering and backward sampling, and lossless decoding.

The lattice of a text has a node after each character and an edge for each piece. No piece goes over from one word into the next, so
a lattice falls apart into words, and one lattice serves all places where a word stands. All distinct words of a chunk
are filtered forward together (logarithms of the total weight of all ways to each node); then every place of every word
draws its way back at the same time. A draw is a hash of the row's seed and the character position, so a row's
segmentation depends on its key and text alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame, functions as F

from .common import KeyIndex, model_bytes
from .token_count import PRE_TOKEN, chunks

CHUNK = 1 << 20
#: Weight of the piece of rank r is (r + SHIFT) ** -POWER: the scores of a BPE model are ranks, not probabilities.
SHIFT, POWER = 2.7, 1.0
BYTES = -2


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the one of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def draws(seed: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Uniform numbers in [0, 1) from the seed of a row and a position in its text."""
    return (mixed(mixed(seed) + position.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)) * 2.0**-53


class Lattice:
    """A trie of the pieces with their log-weights, and the bytes of each piece."""

    def __init__(self, model: bytes, power: float = POWER):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        ids = range(sp.vocab_size())
        pieces = {i: sp.id_to_piece(i).replace("▁", " ") for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
        self.byte_ids = np.array([i for i in ids if sp.is_byte(i)], np.int32)
        if len(self.byte_ids) != 256 or sp.normalize("a▁ b") != "▁a▁▁b" or any(re.search(r"[^ ] ", p) for p in pieces.values()):
            raise ValueError("only models with byte pieces, an identity normaliser and pieces inside words are supported")
        self.spelled = [b""] * sp.vocab_size()
        for i, p in pieces.items():
            self.spelled[i] = p.encode()
        for i in self.byte_ids:
            self.spelled[i] = bytes([int(sp.id_to_piece(int(i))[3:5], 16)])
        self.byte_ids = np.array(sorted(self.byte_ids, key=lambda i: self.spelled[i]), np.int32)
        order = {v: r for r, v in enumerate(sorted({sp.get_score(i) for i in pieces}, reverse=True))}
        rank = {i: order[sp.get_score(i)] for i in pieces}
        total = np.log(sum((r + SHIFT) ** -power for r in rank.values()))
        self.byte_weight = -power * np.log(len(pieces) + SHIFT) - total
        steps: dict[tuple[int, int], int] = {}
        self.piece, self.weight = [-1], [0.0]
        for i, p in pieces.items():
            at = 0
            for c in map(ord, p):
                if (at, c) not in steps:
                    steps[at, c] = len(self.piece)
                    self.piece.append(-1)
                    self.weight.append(0.0)
                at = steps[at, c]
            self.piece[at], self.weight[at] = i, -power * np.log(rank[i] + SHIFT) - total
        self.piece, self.weight = np.array(self.piece), np.array(self.weight)
        keys = sorted((a << 21 | c, to) for (a, c), to in steps.items())
        keys, self.to = (np.array(x, np.int64) for x in zip(*keys))
        self.index = KeyIndex(keys)

    def edges(self, points: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, ...]:
        """(start, end, piece, weight) of all pieces in the words; ``left`` counts the characters from each position to its word's end.

        A character that no piece holds alone has an edge of its bytes.
        """
        found, at, state, length = [], np.arange(len(points)), np.zeros(len(points), np.int64), 0
        alone = np.zeros(len(points), bool)
        while len(at):
            i = self.index.find(state << 21 | points[at + length])
            there = i >= 0
            at, state, length = at[there], self.to[i[there]], length + 1
            ends = self.piece[state] >= 0
            found.append((at[ends], at[ends] + length, self.piece[state[ends]], self.weight[state[ends]]))
            if length == 1:
                alone[at[ends]] = True
            more = left[at] > length
            at, state = at[more], state[more]
        rest = np.flatnonzero(~alone)
        size = 1 + (points[rest] > 0x7F).astype(np.int64) + (points[rest] > 0x7FF) + (points[rest] > 0xFFFF)
        found.append((rest, rest + 1, np.full(len(rest), BYTES), size * self.byte_weight))
        return tuple(np.concatenate(x) for x in zip(*found))

    def filtered(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """Forward filtering of all words: first node of each word, first edge of each node, and of the edges (running share, start node, piece)."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        first_char = np.cumsum(lengths) - lengths
        word = np.repeat(np.arange(len(words)), lengths)
        offset = np.arange(len(points)) - first_char[word]
        start, end, piece, weight = self.edges(points, lengths[word] - offset)
        # word w has one node more than characters: node = character position + w
        depth, length, start, end = offset[end - 1] + 1, end - start, start + word[start], end + word[start]
        order = np.argsort(depth << 36 | end << 8 | length)  # edges of a node side by side, short ones first; nodes by their distance from the word's start
        depth, start, end, piece, weight = (x[order] for x in (depth, start, end, piece, weight))
        total, share = np.zeros(len(points) + len(words)), np.empty(len(start))
        begins = np.flatnonzero(np.r_[True, end[1:] != end[:-1]]) if len(end) else np.zeros(0, np.int64)
        sizes = np.diff(np.r_[begins, len(end)])
        levels = np.flatnonzero(np.r_[True, np.diff(depth[begins]) != 0, True]) if len(end) else []
        for i, j in zip(levels, levels[1:]):
            a, b = begins[i], begins[j - 1] + sizes[j - 1]
            ways, at, n = total[start[a:b]] + weight[a:b], begins[i:j] - a, sizes[i:j]
            top = np.maximum.reduceat(ways, at)
            ways = np.exp(ways - np.repeat(top, n))
            sums = np.add.reduceat(ways, at)
            total[end[begins[i:j]]] = top + np.log(sums)
            share[a:b] = ways / np.repeat(sums, n)
        # running shares, summed node by node so that they do not depend on the rest of the chunk
        place = np.arange(len(end)) - np.repeat(begins, sizes)
        for k in range(1, int(place.max(initial=0)) + 1):
            at = np.flatnonzero(place == k)
            share[at] += share[at - 1]
        run = share
        run[begins + sizes - 1] = 1.0
        first_edge = np.zeros(len(total), np.int64)
        first_edge[end[begins]] = begins
        return first_char + np.arange(len(words)), first_edge, run, start, piece

    def sample(self, texts: list[str], seeds: np.ndarray) -> list[np.ndarray]:
        """The ids of one segmentation of each text."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        held: list[tuple[int, int, str]] = []  # text, character offset in it, chunk

        def settle():
            index: dict[str, int] = {}
            words = [PRE_TOKEN.findall(c) for _, _, c in held]
            places = np.array([index.setdefault(w, len(index)) for ws in words for w in ws], np.int64)
            for (i, _, _), ids in zip(held, self.walk(list(index), places, held, seeds)):
                out[i].append(ids)
            held.clear()

        size = 0
        for i, text in enumerate(texts):
            at = 0
            for chunk in chunks(" " + text if text else "", CHUNK):
                held.append((i, at, chunk))
                at, size = at + len(chunk), size + len(chunk)
                if size >= CHUNK:
                    settle()
                    size = 0
        if held:
            settle()
        return [np.concatenate(x).astype(np.int32) if x else np.zeros(0, np.int32) for x in out]

    def walk(self, words: list[str], places: np.ndarray, held: list[tuple[int, int, str]], seeds: np.ndarray) -> list[np.ndarray]:
        """Backward sampling at all places of the words in the chunks together."""
        first, first_edge, run, back, piece = self.filtered(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))[places]
        ends = np.cumsum(lengths)
        sizes = np.array([len(c) for _, _, c in held])
        total = int(sizes.sum())
        limits = np.cumsum(sizes)
        owner = np.searchsorted(limits, ends - 1, side="right")
        own = np.array([i for i, _, _ in held])[owner]
        shift = (np.array([o for _, o, _ in held]) - (limits - sizes))[owner]  # from a position in the chunks to one in the text
        chosen = np.full(total, -1, np.int64)
        root, node, at, seed = first[places], first[places] + lengths, ends.copy(), seeds[own]
        while len(node):
            edge, drawn = first_edge[node], draws(seed, at + shift)
            later = np.flatnonzero(drawn >= run[edge])
            while len(later):
                edge[later] += 1
                later = later[drawn[later] >= run[edge[later]]]
            step = node - back[edge]
            at, node = at - step, back[edge]
            chosen[at] = piece[edge]
            more = node > root
            root, node, at, seed, shift = (x[more] for x in (root, node, at, seed, shift))
        return [self.ids(c, chosen[a - n:a]) for (_, _, c), a, n in zip(held, limits, sizes)]

    def ids(self, chunk: str, chosen: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(chosen != -1)
        found = chosen[at]
        if not (spelled := np.flatnonzero(found == BYTES)).size:
            return found
        parts, last = [], 0
        for k in spelled:
            parts += [found[last:k], self.byte_ids[list(chunk[at[k]].encode("utf-8", "surrogatepass"))]]
            last = k + 1
        return np.concatenate([*parts, found[last:]])

    def decode(self, ids) -> str:
        return b"".join(map(self.spelled.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids)).decode("utf-8", "surrogatepass")[1:]


@lru_cache(maxsize=2)
def lattice(model: bytes, power: float) -> Lattice:
    return Lattice(model, power)


def seed_of(key: list[str], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *key)


def slices(texts: list[str]) -> Iterator[slice]:
    """Stretches of a batch of about ``CHUNK`` characters."""
    start = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= CHUNK or i + 1 == len(texts):
            yield slice(start, i + 1)
            start, size = i + 1, 0


def encode(df: DataFrame, text: str = "text", key: list[str] = ("doc_id",), name: str = "pieces", lossless: str | None = None, seed: int = 0, power: float = POWER, path: str | None = None) -> DataFrame:
    """Add one sampled segmentation of each whole text as an array of piece ids.

    With ``lossless`` the name of a column, each segmentation is decoded again where it was made, and the column tells whether that gave the text.
    ``power`` is the inverse temperature: large values come near the heaviest segmentation. Null and empty texts have no pieces; null keys are
    keys like others; rows repeated with key and text repeat their pieces; an empty table stays empty; other columns pass through, columns
    already called like the new ones are replaced. One pass without a shuffle.
    """
    model = df.sparkSession.sparkContext.broadcast(model_bytes(path))

    @F.pandas_udf("struct<pieces:array<int>,lossless:boolean>")
    def sampled(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        trie = lattice(model.value, power)
        for batch, seeds in batches:
            texts, seeds = ["" if t is None else t for t in batch], seeds.to_numpy(np.int64).view(np.uint64)
            for part in slices(texts):
                ids = trie.sample(texts[part], seeds[part])
                yield pd.DataFrame({"pieces": ids, "lossless": [not lossless or trie.decode(x) == t for x, t in zip(ids, texts[part])]})

    out = df.withColumn("__sampled", sampled(F.col(text), seed_of(list(key), seed)))
    out = out.withColumn(name, F.col("__sampled.pieces"))
    return (out.withColumn(lossless, F.col("__sampled.lossless")) if lossless else out).drop("__sampled")


def decode(df: DataFrame, pieces: str = "pieces", name: str = "decoded", path: str | None = None) -> DataFrame:
    """Add the text that an array of piece ids spells; the inverse of every segmentation. Null or no pieces give an empty text."""
    model = df.sparkSession.sparkContext.broadcast(model_bytes(path))

    @F.pandas_udf("string")
    def spelled(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        trie = lattice(model.value, POWER)
        for ids in batches:
            yield pd.Series(["" if x is None else trie.decode(x) for x in ids], dtype=object)

    return df.withColumn(name, spelled(F.col(pieces)))
