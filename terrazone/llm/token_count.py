"""Token counts by rank-synchronous array merging.

The pre-tokens of a batch lie one after another in a single numpy array of symbols (a ragged array with a sequence number
for each symbol). One step finds the lowest rank in every sequence and merges it in all sequences at once; sequences without a
pair that joins to a piece leave the arrays with the number of their symbols. Within a sequence all places of the lowest rank
merge together as long as no merge makes a pair of a rank as low; otherwise only the leftmost merges, so that the result is
that of merging one pair at a time.
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

NONE = np.int64(2**40)
PRE_TOKEN = re.compile(r" *[^ ]+| +")
#: Pre-tokens longer than this are cut where no piece holds the two characters side by side.
LONG = 48
#: Characters of text handled at once, and distinct pre-tokens remembered by a worker.
CHUNK, REMEMBERED = 1 << 20, 1 << 19


class PairRanks:
    """Symbols of a BPE piece model and the rank of every two symbols that join to a piece."""

    def __init__(self, model: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        probe = " a  b▁c\n\t　ﬁ "
        if sp.normalize(probe) != ("▁" + probe).replace(" ", "▁"):
            raise ValueError("the model rewrites texts; only an identity normaliser with a leading space is supported")
        ids = range(sp.vocab_size())
        if not any(map(sp.is_byte, ids)):
            raise ValueError("the model has no byte pieces")
        score = {sp.id_to_piece(i).replace("▁", " "): sp.get_score(i) for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
        if any(re.search(r"[^ ] ", p) for p in score):
            raise ValueError("a piece spans two words")
        # the first four symbols stand for unknown characters of one to four bytes
        symbols = ["", "", "", "", *score, *sorted({c for p in score for c in p} - set(score))]
        self.cost = np.array([1, 2, 3, 4] + [1 if s in score else len(s.encode()) for s in symbols[4:]], np.int64)
        number = {s: i for i, s in enumerate(symbols) if s}
        rank = {v: i for i, v in enumerate(sorted(set(score.values()), reverse=True))}
        pairs = sorted((number[p[:k]] << 32 | number[p[k:]], rank[score[p]], number[p]) for p in score for k in range(1, len(p)) if p[:k] in number and p[k:] in number)
        keys, self.ranks, self.joined = (np.array(x, np.int64) for x in zip(*pairs))
        self.index = KeyIndex(keys)
        singles = sorted((ord(s), i) for s, i in number.items() if len(s) == 1)
        self.points, self.point_symbol = (np.array(x, np.int64) for x in zip(*singles))
        self.inside = {p[i:i + 2] for p in score for i in range(len(p) - 1)}
        self.known: dict[str, int] = {}

    def symbols_of(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        at = np.minimum(np.searchsorted(self.points, points), len(self.points) - 1)
        unknown = (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        return np.where(self.points[at] == points, self.point_symbol[at], unknown)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.index.find(left << 32 | right)
        return np.where(at >= 0, self.ranks[at], NONE), np.where(at >= 0, self.joined[at], -1)

    def pairs_at(self, sym: np.ndarray, seq: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of the pair that begins at each position; none at the end of a sequence."""
        after = np.minimum(at + 1, len(sym) - 1)
        rank, joined = self.look_up(sym[at], sym[after])
        rank[(after == at) | (seq[after] != seq[at])] = NONE
        return rank, joined

    def merged_counts(self, words: list[str]) -> np.ndarray:
        """Tokens of each pre-token."""
        counts = np.zeros(len(words), np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        sym, seq = self.symbols_of("".join(words)), np.repeat(np.arange(len(words)), lengths)
        rank, joined = self.pairs_at(sym, seq, np.arange(len(sym)))
        while len(sym):
            starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(sym)]))
            if (over := lowest == NONE).any():
                np.add.at(counts, seq[over], self.cost[sym[over]])
                sym, seq, rank, joined, lowest = (x[~over] for x in (sym, seq, rank, joined, lowest))
                if not len(sym):
                    break
            at = self.places(sym, seq, rank, joined, lowest)
            sym[at] = joined[at]
            stays = np.ones(len(sym), bool)
            stays[at + 1] = False
            now = np.cumsum(stays)[at] - 1
            sym, seq, rank, joined = (x[stays] for x in (sym, seq, rank, joined))
            changed = np.unique(np.r_[now, now[now > 0] - 1])
            rank[changed], joined[changed] = self.pairs_at(sym, seq, changed)
        return counts

    def places(self, sym, seq, rank, joined, lowest) -> np.ndarray:
        """Where to merge in this step."""
        hit = np.flatnonzero(rank == lowest)
        begins = np.r_[True, np.diff(hit) != 1]
        hit = hit[(hit - np.repeat(hit[begins], np.diff(np.r_[np.flatnonzero(begins), len(hit)]))) % 2 == 0]  # of overlapping places every second
        made, own = joined[hit], seq[hit]
        after, before = np.minimum(hit + 2, len(sym) - 1), np.maximum(hit - 1, 0)
        left = sym[before]
        touching = np.r_[False, np.diff(hit) == 2]
        left[touching] = made[:-1][touching[1:]]
        low = (self.look_up(made, sym[after])[0] <= lowest[hit]) & (after == hit + 2) & (seq[after] == own)
        low |= (self.look_up(left, made)[0] <= lowest[hit]) & (before == hit - 1) & (seq[before] == own)
        first = np.r_[True, own[1:] != own[:-1]]
        return hit[first | ~np.isin(own, own[low])] if low.any() else hit

    def parts(self, word: str) -> list[str]:
        """The word, or, if it is long, its stretches between characters which no piece holds side by side."""
        if len(word) <= LONG:
            return [word]
        cuts = [0, *(i for i in range(1, len(word)) if word[i - 1:i + 1] not in self.inside), len(word)]
        return [word[a:b] for a, b in zip(cuts, cuts[1:])]

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each whole text; texts are taken in chunks that end between pre-tokens."""
        found: list[list[str]] = []
        owner: list[int] = []
        totals, held = [0] * len(texts), 0

        def settle():
            new = list({w for words in found for w in words if w not in self.known})
            if len(self.known) + len(new) > REMEMBERED:
                self.known = {}
                new = list({w for words in found for w in words})
            parts = [self.parts(w) for w in new]
            flat = list(dict.fromkeys(p for ps in parts for p in ps))
            number = dict(zip(flat, self.merged_counts(flat).tolist()))
            self.known.update((w, sum(number[p] for p in ps)) for w, ps in zip(new, parts))
            for i, words in zip(owner, found):
                totals[i] += sum(map(self.known.__getitem__, words))
            found.clear(), owner.clear()

        for i, text in enumerate(texts):
            text = " " + text.replace("▁", " ") if text else ""
            for chunk in chunks(text, CHUNK):
                found.append(PRE_TOKEN.findall(chunk))
                owner.append(i)
                held += len(chunk)
                if held >= CHUNK:
                    settle()
                    held = 0
        settle()
        return totals


def chunks(text: str, size: int) -> Iterator[str]:
    """The text in pieces of about ``size`` characters, cut only where a run of spaces begins."""
    start = 0
    while start < len(text):
        end = start + size
        while end < len(text):
            end = text.find(" ", end)
            if end < 0:
                end = len(text)
            elif text[end - 1] == " ":
                end += 1
                continue
            break
        yield text[start:end]
        start = max(end, start + 1)


@lru_cache(maxsize=2)
def pair_ranks(model: bytes) -> PairRanks:
    return PairRanks(model)


def token_counter(df: DataFrame, path: str | None = None):
    """A column function from text to its number of tokens under a BPE piece model (null and empty texts have none)."""
    model = df.sparkSession.sparkContext.broadcast(model_bytes(path))

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ranks = pair_ranks(model.value)
        for texts in batches:
            yield pd.Series(ranks.count(["" if t is None else t for t in texts]), dtype="int64")

    return counted


def count_tokens(df: DataFrame, text: str = "text", name: str = "n_tokens", path: str | None = None) -> DataFrame:
    """Add the number of tokens of each whole text.

    Without begin, end or other added tokens; strings of special tokens inside texts are ordinary text. A null or empty text has
    none. Rows are independent, so repeated rows get equal counts and an empty table stays empty; other columns pass through, and
    one that is already called ``name`` is replaced. One pass without a shuffle.
    """
    counted: Column = token_counter(df, path)(F.col(text))
    return df.withColumn(name, counted)
