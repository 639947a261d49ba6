"""Language-model scores from a hierarchical Pitman-Yor model whose seating is sampled by Gibbs moves.

A word that follows a context is a customer of that context's restaurant; every table there sends one customer to the restaurant
without context, which all context restaurants share as their parent, and whose tables draw from a uniform base over the known words and one
unknown word. Seating is a Markov chain: a customer leaves and is seated again, at a table in proportion to its size less the discount, or
at a new one in proportion to strength, discount and the parent's probability. In a sweep every customer of every pair and of the parent is seated again:
those of a dish with at most ``WHOLE`` all at once, as only the number of their tables counts, whose distribution given all other dishes is known; those of larger
ones one after another in groups of tables. Predictive probabilities are averaged over several seatings.

Restaurants of frequent words are large and the table of (context, word) counts is larger than any machine, so neither is ever in one place:

* Counts are cut into blocks by a hash. Rare words are whole in one block with all their contexts, frequent ones are spread over the blocks by
  context: a rare context has its frequent words in the block where it is itself a word, its home. A word or context is frequent if it has at least
  1 / ``HEAD`` of all training tokens; so there are at most ``HEAD`` of these, whose totals are broadcast.
* One sweep is one pass over the blocks. It moves customers under the table totals of the sweep before, writes the new seating and
  returns the new totals of frequent words and contexts, summed in the cluster. Rare words have their part of the parent restaurant in their block.
  Tables of a rare context's restaurant may stand in several blocks, as its rare words do: each block tells the context's home how many it has, and is
  told their total, in messages that are shuffled. Blocks are tables bucketed by their number, so that they are not shuffled with them. Their numbers
  are chosen so that each has a bucket, and a partition of a shuffle, of its own; no task holds the rows of several blocks at once.
* Scoring sends each document's distinct (context, word) pairs to their blocks, packed; for a rare word after a rare context that was not learned
  together, its block and the context's home give each a part of the probability, which the chunk of texts puts together; pairs that alone hold 1 / ``HEAD`` of all tokens are
  broadcast with their probability and scored where the text is, so that no block receives a pair more often than that. Sums come back to the
  documents of a chunk of texts, packed as well.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import let_workers_import, remove, shared_path, stash
from .sampled_pieces import mixed

#: Words (or contexts, or pairs) are frequent from this share of the training tokens on; training tokens of a block on average.
HEAD, BLOCK = 1 << 20, 1 << 22
#: Sweeps before the first sampled seating, and sampled seatings; how often every customer is seated again in a sweep.
BURN_IN, SAMPLES, PASSES = 3, 3, 1
#: Customers of a dish that are seated at once at most; tables, on average, of a group of a larger dish's tables; numbers that are worked on at once.
WHOLE, TABLES, CELLS = 1024, 4, 1 << 17
#: Discount and strength of the context restaurants and of their parent.
CONTEXT, PARENT = (0.8, 1.0), (0.6, 20.0)
#: Characters of texts that are packed at once.
CHUNK = 6 << 20
#: No word holds white space, so none is the end.
END = int(np.uint64(xxhash.xxh3_64_intdigest(b" end")).view(np.int64))
LIBC = ctypes.CDLL(None) if os.name == "posix" else None
WIDTH = 1 << 21  # more than frequent words and contexts; no hash of a word lies between 0 and it


@dataclass
class Model:
    """Totals of the corpus and of one seating, as far as they are bounded: at most ``HEAD`` words."""
    words: np.ndarray                   # hashes of the frequent words, sorted
    counts: np.ndarray                  # training tokens after each context: the frequent words, then the start
    tokens: int
    known: int                          # different training tokens
    share: int                          # the inverse share from which words, contexts and pairs are frequent
    blocks: int
    tables: np.ndarray                  # tables of each context's restaurant
    head: np.ndarray                    # the parent's probability of each frequent word
    customers: int = 0                  # of the parent restaurant
    shared: int = 0                     # its tables
    samples: list = field(default_factory=list)  # (tables, head, customers, shared) of the sampled seatings
    pairs: np.ndarray | None = None     # the frequent pairs, and their probabilities
    p: np.ndarray | None = None
    numbers: np.ndarray | None = None   # of the blocks, if they are not numbered from 0 on

    @property
    def start(self) -> int:
        return len(self.words)

    @property
    def rare(self) -> int:
        return len(self.words) + 1

    def coded(self, h: np.ndarray) -> np.ndarray:
        """Words as their number if they are frequent, else as their hash."""
        at = found_at(self.words, h)
        return np.where(at >= 0, at, h)

    def block(self, word: np.ndarray, context: np.ndarray) -> np.ndarray:
        near = word.view(np.uint64) ^ mixed(context.view(np.uint64) + np.uint64(1))
        by = np.where(frequent(word), np.where(frequent(context), near, context.view(np.uint64)), word.view(np.uint64))
        return self.numbered(mixed(mixed(by)))

    def numbered(self, h: np.ndarray) -> np.ndarray:
        """The numbers of the blocks that hashes fall to."""
        at = (h % np.uint64(self.blocks)).astype(np.int64)
        return at if self.numbers is None else self.numbers[at]

    def base(self, customers: int, shared: int) -> float:
        """The parent's probability of a word nobody sits at."""
        discount, strength = PARENT
        return (strength + discount * shared) / (self.known + 1) / (strength + customers)

    def parent(self, own: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """The parent's probability of words with so many customers and tables there."""
        return (own - PARENT[0] * tables) / (PARENT[1] + self.customers) + self.base(self.customers, self.shared)

    def seat_parent(self, customers: np.ndarray, seats: "Seats | None", draw: np.random.Generator, passes: int) -> "Seats":
        """The parent's seating of words with so many customers now: from the last one, if any."""
        discount, strength = PARENT
        new = np.full(len(customers), (strength + discount * self.shared) / (self.known + 1))
        if seats is None:
            seats = Seats.opened(customers, new, discount, draw)
        else:
            seats.resize(customers, new, discount)
        seats.move(new, discount, passes)
        return seats


def release() -> None:
    """Free memory goes back to the system: workers live on and would hold what their largest task once took."""
    pa.default_memory_pool().release_unused()
    if hasattr(LIBC, "malloc_trim"):
        LIBC.malloc_trim(0)


def frequent(word: np.ndarray) -> np.ndarray:
    return (word >= 0) & (word < WIDTH)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, whole numbers in as few bytes as their range allows."""
    small = [a.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.int64) if not len(a) or t is np.int64 or (a.min() >= 0 and a.max() <= np.iinfo(t).max))) if a.dtype.kind in "iu" else a for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(np.array([len(small), *map(len, small), *[ord(a.dtype.char) for a in small]], np.int64).tobytes() + b"".join(a.tobytes() for a in small))


def unpack(data: bytes) -> list[np.ndarray]:
    """The arrays again, whole numbers as 64 bits."""
    data = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    about = np.frombuffer(data, np.int64, 2 * n, 8)
    out, at = [], 8 + 16 * n
    for size, kind in zip(about[:n], about[n:]):
        a = np.frombuffer(data, np.dtype(chr(kind)), int(size), at)
        at += a.nbytes
        out.append(a.astype(np.int64) if a.dtype.kind in "iu" else a)
    return out


def runs(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones of sorted words, and how often each stands there."""
    begins = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else np.zeros(0, np.int64)
    return word[begins], np.diff(np.r_[begins, len(word)])


def shorter(word: np.ndarray) -> list[np.ndarray]:
    """Sorted words as runs: how often each, steps between frequent ones, and hashes of the others."""
    each, times = runs(word)
    head = frequent(each)
    return [times, np.diff(each[head], prepend=0), each[~head]]


def longer(times: np.ndarray, steps: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return np.repeat(np.sort(np.r_[np.cumsum(steps), hashes]), times)


@lru_cache(maxsize=4)
def ways(discount: float, most: int) -> np.ndarray:
    """Logarithms of generalised Stirling numbers: in row n, column t the summed weights of all seatings of n customers at t tables, without those of new tables."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[0, 0] = 0
    for n in range(most):
        out[n + 1, 1:n + 2] = np.logaddexp(out[n, :n + 1], out[n, 1:n + 2] + np.log(np.maximum(n - discount * np.arange(1, n + 2), 1e-300)))
    return out


class Seats:
    """Tables of many dishes at once: ``n`` customers and ``t`` tables of each dish, and the customers at each table of the dishes with more than ``WHOLE``, one dish after another."""

    def __init__(self, t: np.ndarray, sizes: np.ndarray, draw: np.random.Generator, n: np.ndarray | None = None):
        """``sizes`` are those of all tables if ``n`` is not told, else those of the dishes with more than ``WHOLE`` customers."""
        self.t, self.draw = t.astype(np.int64), draw
        if n is None:
            n = np.bincount(np.repeat(np.arange(len(t)), t), sizes, len(t))
            sizes = sizes[np.repeat(n > WHOLE, t)]
        self.n, self.sizes = n.astype(np.int64), sizes.astype(np.int64)

    @classmethod
    def opened(cls, n: np.ndarray, new: np.ndarray, discount: float, draw: np.random.Generator) -> "Seats":
        """A seating to begin a chain with."""
        t, large = np.minimum(n, 1), n > WHOLE
        t[large], sizes = cls.opening(n[large], new[large], discount)
        return cls(t, sizes, draw, n)

    def move(self, new: np.ndarray, discount: float, passes: int = PASSES) -> None:
        """So often every customer of every dish leaves and is seated again; ``new`` is the weight of a new table."""
        for _ in range(passes):
            self.seat_at_once(new, discount)
            if len(self.sizes):
                self.seat_singly(new, discount)

    def seat_at_once(self, new: np.ndarray, discount: float) -> None:
        """All customers of each of the smaller dishes leave and are seated together: their number of tables is drawn from its distribution."""
        some = np.flatnonzero((self.n > 1) & (self.n <= WHOLE))
        some = some[np.argsort(self.n[some].astype(np.int16), kind="stable")]
        table, log_new = ways(discount, WHOLE), np.log(new[some])
        each, times = runs(self.n[some])
        for n, begin, end in zip(each, np.cumsum(times) - times, np.cumsum(times)):
            step, t = max(1, CELLS // int(n)), np.arange(1, n + 1)[:, None]
            for a in range(begin, end, step):
                w = t * log_new[a:min(a + step, end)] + table[n, 1:n + 1, None]
                w -= w.max(0)
                w = np.exp(w, out=w).cumsum(0)
                self.t[some[a:a + w.shape[1]]] = 1 + (w < self.draw.random(w.shape[1]) * w[-1]).sum(0)

    def seat_singly(self, new: np.ndarray, discount: float) -> None:
        """Each customer of the larger dishes leaves and is seated again, one after another.

        The weight of a seating is a product over its tables. So the tables of a dish may be dealt to groups at random, with a new table's weight divided by the groups' number, and given
        which customers are in a group, groups are independent of each other: their customers move side by side. Groups are dealt anew each time. Tables are large from a limit on, also drawn
        each time, and stay on their side of it: customers of large tables change places in pairs of these, and leave them one by one for others. That leaves the distribution as it is.
        """
        draw, s, many = self.draw, self.sizes, np.flatnonzero(self.n > WHOLE)
        dish, limit = np.repeat(np.arange(len(many)), self.t[many]), int(2 ** self.draw.uniform(4, 7))
        large = np.flatnonzero(s >= limit)
        large = large[np.lexsort((draw.random(len(large)), dish[large]))]
        _, times = runs(dish[large])
        odd = (np.arange(len(large)) - np.repeat(np.cumsum(times) - times, times)) % 2 == 1
        one, two = large[:-1][odd[1:]], large[1:][odd[1:]]
        both = s[one] + s[two]
        there = draw.binomial(both, draw.beta(s[one] - discount, s[two] - discount))
        there = np.where((there >= limit) & (both - there >= limit), there, s[one])
        s[one], s[two] = there, both - there
        groups = np.maximum(np.minimum(self.n[many], 1 + new[many] / discount) / TABLES, 1).astype(np.int64)
        group = (np.cumsum(groups) - groups)[dish] + (draw.random(len(dish)) * groups[dish]).astype(np.int64)
        order = np.argsort(group, kind="stable")
        s, dish = s[order], dish[order]
        _, times = runs(group[order])
        begins, found = np.cumsum(times) - times, []
        by_size = np.argsort(times, kind="stable")
        for at in range(0, len(by_size), 4096):
            some = by_size[at:at + 4096]
            row = np.repeat(np.arange(len(some)), times[some])
            place = np.arange(len(row)) - np.repeat(np.cumsum(times[some]) - times[some], times[some])
            tables = np.zeros((len(some), int(times[some].max()) + 4), np.int64)
            tables[row, place] = s[begins[some][row] + place]
            owner = dish[begins[some]]
            row, sizes = seated_singly(tables, (new[many] / groups)[owner], discount, limit, draw)
            found.append((owner[row], sizes))
        dish, s = (np.concatenate(x) for x in zip(*found))
        self.sizes, self.t[many] = s[np.argsort(dish, kind="stable")], np.bincount(dish, minlength=len(many))

    def resize(self, n: np.ndarray, new: np.ndarray, discount: float) -> None:
        """So many customers of each dish instead: random ones leave, or further ones sit down at its tables until they are moved."""
        was, large, draw = self.n > WHOLE, n > WHOLE, self.draw
        kept, fresh = np.flatnonzero(was & large), np.flatnonzero(large & ~was)
        t, change = self.t[kept], (n - self.n)[kept]
        s = self.sizes[np.repeat(large[was], self.t[was])]
        begin = np.cumsum(t) - t
        s[begin[t == 1]] += change[t == 1]
        for i in np.flatnonzero((t > 1) & (change != 0)):
            own = s[begin[i]:begin[i] + t[i]]
            own += draw.multinomial(change[i], (own - discount) / (own - discount).sum()) if change[i] > 0 else -draw.multivariate_hypergeometric(own, -change[i])
        dish = np.repeat(kept, t)[s > 0]
        opened, sizes = self.opening(n[fresh], new[fresh], discount)
        dish, s = np.r_[dish, np.repeat(fresh, opened)], np.r_[s[s > 0], sizes]
        self.n, self.t, self.sizes = n.astype(np.int64), np.clip(self.t, np.minimum(n, 1), n), s[np.argsort(dish, kind="stable")]
        self.t[large] = np.bincount(dish, minlength=len(n))[large]

    def state(self) -> tuple[np.ndarray, np.ndarray]:
        """Tables of each dish and the customers at each; those of the smaller dishes as if all tables but one had one customer."""
        sizes, some = np.ones(int(self.t.sum()), np.int64), self.t > 0
        sizes[(np.cumsum(self.t) - self.t)[some]] = (self.n - self.t + 1)[some]
        sizes[np.repeat(self.n > WHOLE, self.t)] = self.sizes
        return self.t.astype(np.int32), sizes

    @staticmethod
    def opening(n: np.ndarray, new: np.ndarray, discount: float) -> tuple[np.ndarray, np.ndarray]:
        """A first seating: about as many tables as are expected, all but one with one customer."""
        t, seated = np.minimum(n, 1).astype(float), np.minimum(n, 1).astype(float)
        while (seated < n).any():
            step = np.minimum(np.maximum(1.0, seated // 4), n - seated)
            t += step * new / (seated - discount * t + new)
            seated += step
        t = np.clip(np.round(t), np.minimum(n, 1), n).astype(np.int64)
        sizes = np.ones(int(t.sum()), np.int64)
        some = t > 0
        sizes[(np.cumsum(t) - t)[some]] = (n - t + 1)[some]
        return t, sizes


def seated_singly(s: np.ndarray, new: np.ndarray, discount: float, limit: int, draw: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Each customer of groups of tables leaves and is seated again, in random order: the group and size of each table then, from the sizes of each group's, with zeros for free places.

    Customers of large tables leave them for others than large ones with the same probability, whichever their table. So those who don't, until one does or a customer
    of a small table has its turn, are only counted: their number is the smaller one of a geometric draw and of those who come before the first of the small ones.
    """
    todo, large, live, found = s.copy(), s >= limit, np.arange(len(s)), []
    few, many = (s * ~large).sum(1), (s * large).sum(1)
    while len(live):
        w = s - discount
        held = (w * large).sum(1)
        w[large | (s == 0) | (s == limit - 1)] = 0
        out = w.sum(1) + new
        stay = np.where(few > 0, draw.binomial(many, 1 - draw.random(len(live)) ** (1 / np.maximum(few, 1))), many)
        before = draw.geometric(out / (out + np.maximum(held - 1, 0))) - 1
        leave = before < stay
        many -= np.where(leave, before + 1, stay)
        more = leave | (few > 0)
        few -= ~leave
        if not more.all():
            row, place = np.nonzero(s * ~more[:, None])
            found.append((live[row], s[row, place]))
            s, todo, large, live, new, few, many, leave = (x[more] for x in (s, todo, large, live, new, few, many, leave))
        rows = np.arange(len(live))
        turn = (todo * (large == leave[:, None])).cumsum(1)
        k = (turn > (draw.random(len(live)) * turn[:, -1])[:, None]).argmax(1)
        todo[rows, k] -= 1
        goes = ~leave | (s[rows, k] > limit)
        rows, k = rows[goes], k[goes]
        s[rows, k] -= 1
        own, big = s[rows], large[rows]
        free = own == 0
        w = own - discount
        w[free | (big & leave[rows, None]) | (~big & (own == limit - 1))] = 0
        w = w.cumsum(1)
        x = draw.random(len(rows)) * (w[:, -1] + new[rows]) - new[rows]
        to = (w > np.minimum(x, np.nextafter(w[:, -1], 0))[:, None]).argmax(1)
        if not free.any(1).all():
            room = np.zeros((len(s), 8), np.int64)
            s, todo, large, free = np.c_[s, room], np.c_[todo, room], np.c_[large, room > 0], np.c_[free, np.ones((len(rows), 8), bool)]
        s[rows, np.where(x < 0, free.argmax(1), to)] += 1
    return tuple(np.concatenate(x) for x in zip(*found))


def training(key: Column, fold: int = 7, out: int = 2) -> Column:
    """Whether a document is learned from; a null key is."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % fold != out, F.lit(True))


def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, tokens of each row with its end, the tokens as numbers, and the hash of each number; texts of about ``CHUNK`` characters at once."""
    for batch in batches:
        size = np.cumsum(np.fromiter((len(t) if isinstance(t, str) else 0 for t in batch["text"]), np.int64, len(batch)))
        begins = np.flatnonzero(np.diff(size // CHUNK, prepend=-1) > 0)  # where another multiple of CHUNK is passed
        for begin, end in zip(begins, [*begins[1:], len(batch)]):
            texts = pc.fill_null(pa.array(batch["text"].iloc[begin:end], pa.large_string(), from_pandas=True), "")
            split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
            words, offsets = split.flatten(), split.offsets.to_numpy() - split.offsets[0].as_py()
            some = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
            lengths = np.diff(np.r_[0, np.cumsum(some)][offsets])
            coded = words.filter(pa.array(some)).dictionary_encode()
            ids = np.zeros(len(coded) + len(lengths), np.int64)  # 0: ends
            ids[np.arange(len(coded)) + np.repeat(np.arange(len(lengths)), lengths)] = coded.indices.to_numpy() + 1
            h = np.fromiter(map(xxhash.xxh3_64_intdigest, coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False)), np.uint64, len(coded.dictionary)).view(np.int64)
            h[(h >= 0) & (h < WIDTH)] += 2 * WIDTH
            del texts, split, words, coded
            release()
            yield batch.iloc[begin:end], lengths + 1, ids, np.r_[END, h]


def with_contexts(lengths: np.ndarray, ids: np.ndarray, h: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Each distinct word in the model's code, and the context of each token."""
    word = model.coded(h)
    context = word[np.r_[0, ids[:-1]]]
    context[np.cumsum(lengths) - lengths] = model.start
    return word, context


def distinct_items(lengths: np.ndarray, ids: np.ndarray, word: np.ndarray, start: int, doc: np.ndarray, docs: int, taken: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """The distinct (word, context, document) of tokens in this order, words and contexts in the model's code, and how often each stands there."""
    codes = np.r_[word, start]
    order = np.argsort(codes)
    rank = np.empty(len(codes), np.int64)
    rank[order] = np.arange(len(codes))
    before = np.r_[len(word), ids[:-1]]
    before[np.cumsum(lengths) - lengths] = len(word)
    item = (rank[ids] * len(codes) + rank[before]) * docs + doc
    item, n = runs(np.sort(item if taken is None else item[taken]))
    pair, doc = np.divmod(item, docs)
    word, context = np.divmod(pair, len(codes))
    return codes[order[word]], codes[order[context]], doc, n


def folded(context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Contexts as small numbers, and the sorted hashes of the rare ones, which count on from ``WIDTH``."""
    rare = ~frequent(context)
    far, _ = runs(np.sort(context[rare]))
    out = context.copy()
    out[rare] = WIDTH + found_at(far, context[rare])
    return out, far


def unfolded(context: np.ndarray, far: np.ndarray) -> np.ndarray:
    out = context.copy()
    out[context >= WIDTH] = far[context[context >= WIDTH] - WIDTH]
    return out


def in_blocks(block: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    order = np.argsort(block.astype(np.uint16) if block.max(initial=0) < 1 << 16 else block, kind="stable")
    begins = np.flatnonzero(np.r_[True, np.diff(block[order]) != 0]) if len(block) else []
    arrays = [a[order] for a in arrays]
    for a, b in zip(begins, [*begins[1:], len(block)]):
        yield int(block[order[a]]), [x[a:b] for x in arrays]


def tokenized(docs: DataFrame) -> DataFrame:
    """(chunk, keys, data) of documents (key, text, learned): the tokens of a chunk of texts as packed numbers, with the hash of each number."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number = TaskContext.get().partitionId(), 0
        for rows, lengths, ids, h in chunks(batches):
            number += 1
            keys = rows["key"].astype(object).where(rows["key"].notna(), None).tolist()
            data = pack(lengths, rows["learned"].to_numpy(bool).astype(np.uint8), h, ids & 255, ids >> 8 & 255, ids >> 16)
            yield pd.DataFrame({"chunk": [(part << 32) + number], "keys": [keys], "data": [data]})

    return docs.select(F.col("key").cast("string").alias("key"), "text", "learned").mapInPandas(run, "chunk long, keys array<string>, data binary")


def cut(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of each text of a chunk, whether it is learned from, the tokens as numbers, and the hash of each number."""
    lengths, learned, h, low, middle, high = unpack(data)
    return lengths, learned == 1, low | middle << 8 | high << 16, h


def count_words(tokens: DataFrame) -> DataFrame:
    """(h, n) of the words of the documents that are learned from, ends included."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["data"]:
                lengths, learned, ids, h = cut(data)
                n = np.bincount(ids[np.repeat(learned, lengths)], minlength=len(h))
                yield pd.DataFrame({"h": h[n > 0], "n": n[n > 0]})

    return tokens.select("data").mapInPandas(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def packed_pairs(tokens: DataFrame, model) -> DataFrame:
    """(block, data) of the pairs of training documents, counted in chunks: words, contexts, counts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model.value
        for batch in batches:
            for data in batch["data"]:
                lengths, learned, ids, h = cut(data)
                word, context, _, n = distinct_items(lengths, ids, m.coded(h), m.start, 0, 1, np.repeat(learned, lengths))
                rows = list(in_blocks(m.block(word, context), word, context, n))
                yield pd.DataFrame({"block": [b for b, _ in rows], "data": [pack(*shorter(w), *folded(c), k) for _, (w, c, k) in rows]})
                del word, context, n, rows
                release()

    return tokens.select("data").mapInPandas(run, "block int, data binary")


def own_numbers(spark: SparkSession, blocks: int) -> np.ndarray:
    """So many numbers that Spark's hash deals to different ones of as many buckets or partitions."""
    found, ids = None, 16 * blocks + 64
    while found is None or len(found) < blocks:
        number = F.col("id").cast("int")
        found = spark.range(ids).groupBy(F.pmod(F.hash(number), F.lit(blocks)).alias("bucket")).agg(F.min(number).alias("number")).collect()
        ids *= 2
    return np.array(sorted(row["number"] for row in found), np.int64)


class Row(dict):
    """A row of an Arrow batch; binary values are views of the batch, not copies."""
    __getattr__ = dict.__getitem__


def arrow_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[Row]:
    binary = (pa.binary(), pa.large_binary())

    def value(x):
        if pa.types.is_list(x.type) and x.type.value_type in binary:
            return [v.as_buffer() for v in x.values]
        return x.as_buffer() if x.type in binary else x.as_py()

    for batch in batches:
        for i in range(batch.num_rows):
            yield Row((name, value(column[i])) for name, column in zip(batch.schema.names, batch.columns))


def arrow_batch(schema: pa.Schema, *rows: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), schema.types)], schema=schema)


def by_block(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, Iterator]]:
    """The rows of each block one after another; blocks stand together."""
    return in_turn(row for batch in batches for row in batch.itertuples(index=False))


def in_turn(rows: Iterator) -> Iterator[tuple[int, Iterator]]:
    held = {"row": None}
    held["row"] = next(rows, None)

    def same(block):
        while held["row"] is not None and held["row"].block == block:
            row, held["row"] = held["row"], next(rows, None)
            yield row

    while held["row"] is not None:
        block = held["row"].block
        yield block, same(block)


NONE = np.zeros(0, np.int64)
#: Rows of swept blocks, and of sums that are found for a chunk of texts.
SWEPT = pa.schema({"block": pa.int32(), "data": pa.binary(), "about": pa.binary(), "told": pa.list_(pa.struct({"home": pa.int32(), "data": pa.binary()}))})
FOUND = pa.schema({"chunk": pa.int64(), "kind": pa.int32(), "data": pa.binary(), "keys": pa.list_(pa.string())})


@dataclass
class Block:
    """The pairs of a block by word and context, the seating of those with several customers, and the parent's seating of its rare words."""
    word: np.ndarray
    context: np.ndarray         # frequent ones, and from WIDTH on places in ``far``
    n: np.ndarray
    t: np.ndarray               # tables of the pairs with several customers
    sizes: np.ndarray           # customers at each table of those with more than ``WHOLE``
    total: np.ndarray           # sums of t over the sampled seatings
    own_t: np.ndarray           # the parent's tables of each rare word, and customers at them as in ``sizes``
    own_sizes: np.ndarray
    own: np.ndarray             # customers less discounted tables there, of each sampled seating, one after another
    far: np.ndarray = field(default_factory=lambda: NONE)   # sorted hashes of the rare contexts, the block's rare words among them
    live: np.ndarray = field(default_factory=lambda: NONE)  # whether any block has a pair of them with several customers; others' tables never change
    sums: np.ndarray = field(default_factory=lambda: NONE)  # their tables in this block, of each sampled seating, one after another

    def pack(self) -> bytes:
        times, steps, hashes = shorter(self.word)
        return pack(times, steps, hashes, self.context, self.n, self.t, self.sizes, self.total, self.own_t, self.own_sizes, self.own, self.far[found_at(hashes, self.far) < 0], self.live, self.sums)

    @classmethod
    def unpack(cls, data: bytes) -> "Block":
        times, steps, hashes, *rest, others, live, sums = unpack(data)
        return cls(longer(times, steps, hashes), *rest, np.sort(np.r_[hashes, others]), live, sums)

    def tables(self) -> np.ndarray:
        """Tables of each pair."""
        out = np.ones(len(self.word), np.int64)
        out[self.n > 1] = self.t
        return out

    def by_far(self, amount: np.ndarray) -> np.ndarray:
        """Sums of whole numbers of the pairs by rare context."""
        rare = self.context >= WIDTH
        return np.bincount(self.context[rare] - WIDTH, amount[rare], len(self.far)).astype(np.int64)

    def to_homes(self, m: Model, only_live: bool) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rare contexts, or of the live ones, in the order of their homes, and these homes."""
        at = np.flatnonzero(self.live) if only_live else np.arange(len(self.far))
        home = m.block(self.far[at], self.far[at])
        order = np.argsort(home, kind="stable")
        return at[order], home[order]

    def told(self, m: Model, first: bool, last: bool) -> list[tuple[int, bytes]]:
        """What each home is told of its contexts: their tables here; at first also whether they can change, at last their customers and the tables of each sampled seating."""
        if last:
            amounts = [self.by_far(self.n), *self.sums.reshape(-1, len(self.far))] if len(self.far) else []
        else:
            amounts = [self.by_far(self.tables())] + ([self.by_far(self.n > 1)] if first else [])
        at, home = self.to_homes(m, not (first or last))
        return [(b, pack(far, *own)) for b, (far, *own) in in_blocks(home, self.far[at], *[x[at] for x in amounts])]

    def heard(self, m: Model, replies, amounts: int, only_live: bool = False) -> np.ndarray:
        """The sums over all blocks of what homes were told, by rare context; ``replies`` are in the order of homes."""
        out = np.zeros((amounts, len(self.far)), np.int64)
        parts = [unpack(r) for r in replies]
        if parts:
            out[:, self.to_homes(m, only_live)[0]] = [np.concatenate([p[i] for p in parts]) for i in range(amounts)]
        return out

    def swept(self, m: Model, draw: np.random.Generator, sampled: bool, passes: int, around: np.ndarray | None = None) -> tuple["Block", bytes]:
        """The block after a sweep, and its totals; ``around`` are the tables of the rare contexts in all blocks."""
        head = frequent(self.word)
        rare, times = runs(self.word[~head])
        at = np.repeat(np.arange(len(rare)), times)  # of the pairs of rare words
        several = self.n > 1
        discount, strength = CONTEXT
        own_n = np.bincount(at, self.tables()[~head], len(rare)).astype(np.int64) if len(self.own_t) else None
        if own_n is None:  # the first sweep: the parent's probability is a word's share of all tokens
            p_rare = np.bincount(at, self.n[~head], len(rare)) / m.tokens
        else:
            p_rare = m.parent(own_n, self.own_t)
        p = np.zeros(int(several.sum()))
        p[head[several]], p[~head[several]] = m.head[self.word[several & head]], p_rare[at[several[~head]]]
        context = self.context[several]
        tables = m.tables[np.minimum(context, m.start)].astype(float)
        tables[context >= WIDTH] = (self.by_far(self.n) / 2 if around is None else around)[context[context >= WIDTH] - WIDTH]
        new = (strength + discount * tables) * p
        n = self.n[several]
        seats = Seats(self.t, self.sizes, draw, n) if len(self.t) else Seats.opened(n, new, discount, draw)
        seats.move(new, discount, passes)
        t, sizes = seats.t.astype(np.int32), seats.sizes
        del seats, new, p, context, n
        out = replace(self, t=t, sizes=sizes)
        tables = out.tables()
        # the parent's restaurant: rare words here, frequent ones where the totals are added up
        customers = np.bincount(at, tables[~head], len(rare)).astype(np.int64)
        parent = m.seat_parent(customers, None if own_n is None else Seats(self.own_t, self.own_sizes, draw, own_n), draw, passes)
        own_t, own_sizes = parent.t.astype(np.int32), parent.sizes
        total = (self.total if len(self.total) else np.zeros(len(t), np.int32)) + (t if sampled else 0)
        own = np.r_[self.own, customers - PARENT[0] * own_t].astype(np.float64) if sampled else self.own
        near = self.context < WIDTH
        sums = np.bincount(self.context[near], tables[near]).astype(np.int64), np.bincount(self.word[head], tables[head]).astype(np.int64)
        contexts, heads = np.flatnonzero(sums[0]), np.flatnonzero(sums[1])
        about = pack(contexts, sums[0][contexts], heads, sums[1][heads], np.array([customers.sum(), own_t.sum()], np.int64))
        return replace(out, total=total.astype(np.int32), own_t=own_t, own_sizes=own_sizes, own=own, sums=np.r_[self.sums, out.by_far(tables)] if sampled else self.sums), about


class Predictions:
    """Averaged predictive probabilities and counts of the words of a block."""

    def __init__(self, block: Block, m: Model, replies=()):
        self.m = m
        several = block.n > 1
        self.seated = np.where(several, 0.0, 1 - CONTEXT[0])
        self.seated[several] = block.n[several] - CONTEXT[0] * block.total / len(m.samples)
        self.seated = np.r_[self.seated, 0.0]
        self.words, times = runs(block.word)
        self.counts = np.r_[np.add.reduceat(block.n, np.cumsum(times) - times) if len(times) else block.n, 0]
        # customers and tables of the contexts: the frequent ones, one never seen, the rare ones
        self.far, known = block.far, block.heard(m, replies, 1 + len(m.samples))
        self.customers, self.tables = np.r_[m.counts, 0, known[0]], [np.r_[tables, 0, k] for (tables, *_), k in zip(m.samples, known[1:])]
        self.pair = np.repeat(np.arange(len(self.words)), times) * len(self.customers) + np.where(block.context < WIDTH, block.context, block.context - WIDTH + m.rare + 1)
        self.rare = self.words[~frequent(self.words)]
        self.own = block.own.reshape(len(m.samples), len(self.rare)) if len(self.rare) else np.zeros((len(m.samples), 0))

    def place(self, context: np.ndarray) -> np.ndarray:
        """Places of contexts among customers and tables."""
        out, rare = np.minimum(context, self.m.rare), ~frequent(context)
        at = found_at(self.far, context[rare])
        out[rare] = self.m.rare + np.where(at >= 0, 1 + at, 0)
        return out

    def parents(self, words: np.ndarray) -> list[np.ndarray]:
        """The parent's probabilities of distinct words, in each sampled seating."""
        m, head, at = self.m, frequent(words), found_at(self.rare, words)
        mine = ((np.where(at >= 0, np.r_[own, 0.0][at], 0.0), seating) for own, seating in zip(self.own, m.samples))
        return [np.where(head, np.r_[heads, 0.0][np.where(head, words, -1)], x / (PARENT[1] + customers) + m.base(customers, shared)) for x, (_, heads, customers, shared) in mine]

    def at_tables(self, words: np.ndarray, number: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Customers less discounted tables of words in the restaurants of contexts."""
        pair = found_at(self.pair, np.where(place == self.m.rare, -1, found_at(self.words, words)[number] * len(self.customers) + place))
        return np.where(pair >= 0, self.seated[pair], 0.0)

    def of(self, word: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Probabilities of sorted words after contexts."""
        words, times = runs(word)
        number, place = np.repeat(np.arange(len(words)), times), self.place(context)
        return averaged(self.at_tables(words, number, place), [p[number] for p in self.parents(words)], self.customers[place], [t[place] for t in self.tables])

    def count(self, word: np.ndarray) -> np.ndarray:
        """Training tokens of rare ones of sorted words."""
        words, times = runs(word)
        return np.repeat(self.counts[found_at(self.words, words)] * ~frequent(words), times)


def averaged(seated: np.ndarray, parents: list[np.ndarray], customers: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """Probabilities in restaurants with so many customers and tables, over the sampled seatings."""
    discount, strength = CONTEXT
    return (seated + sum(p * (strength + discount * t) for p, t in zip(parents, tables)) / len(tables)) / (strength + customers)


def found_at(known: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Places of values among sorted distinct ones, -1 where they are not."""
    if not len(known):
        return np.full(len(asked), -1)
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    return np.where(known[at] == asked, at, -1)


def first_block(parts) -> Block:
    """A block without seating, from words, contexts and counts of chunks, of which one after another is looked at."""
    held = []
    for word, context, n in parts:
        context, far = folded(context)
        held.append((*runs(word), context.astype(np.int32), far, n.astype(np.int32)))
    words, _ = runs(np.sort(np.concatenate([NONE, *[p[0] for p in held]])))
    far, _ = runs(np.sort(np.concatenate([words[~frequent(words)], *[p[3] for p in held]])))
    wide, n = WIDTH + len(far), np.concatenate([np.zeros(0, np.int32), *[p[4] for p in held]])
    pair, at = np.zeros(len(n), np.int64), 0
    for each, times, context, own, _ in held:
        context = context.astype(np.int64)
        context[context >= WIDTH] = WIDTH + found_at(far, own)[context[context >= WIDTH] - WIDTH]
        pair[at:at + len(context)] = np.repeat(found_at(words, each), times) * wide + context
        at += len(context)
    held.clear()
    order = np.argsort(pair)
    n, (pair, times) = n[order], runs(pair[order])
    n = np.add.reduceat(n, np.cumsum(times) - times, dtype=np.int64) if len(pair) else NONE
    return Block(words[pair // wide], pair % wide, n, *[NONE] * 5, np.zeros(0), far)


def fit(docs: DataFrame, seed: int = 0, share: int = HEAD, size: int = BLOCK, burn_in: int = BURN_IN, samples: int = SAMPLES, passes: int = PASSES) -> tuple[Model, DataFrame, DataFrame]:
    """The bounded part of a model, the blocks (block, data, replies) of the rest, and the counts (h, n) of all words, from documents (text)."""
    return fit_tokens(tokenized(docs.select(F.lit(None).alias("key"), "text", F.lit(True).alias("learned"))), seed, share, size, burn_in, samples, passes)


def fit_tokens(cuts: DataFrame, seed: int = 0, share: int = HEAD, size: int = BLOCK, burn_in: int = BURN_IN, samples: int = SAMPLES, passes: int = PASSES) -> tuple[Model, DataFrame, DataFrame]:
    """The same from documents as ``tokenized`` has cut them, those that are learned from."""
    spark = cuts.sparkSession
    words, _ = stash(count_words(cuts), "lm-words")
    tokens, known, n_docs = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.sum(F.when(F.col("h") == END, F.col("n"))), F.lit(0))).first()
    frequent = words.where(F.col("n") * share >= F.lit(tokens)).toPandas().sort_values("h")  # at most ``share`` rows
    h, n = frequent["h"].to_numpy(np.int64), frequent["n"].to_numpy(np.int64)
    counts = np.r_[np.where(h == END, 0, n), n_docs].astype(np.int64)
    m = Model(h, counts, tokens, known, share, max(1, -(-tokens // size)), counts / 2, n / max(tokens, 1))
    m.numbers = own_numbers(spark, m.blocks)
    parents: Seats | None = None
    draw = np.random.default_rng([seed, 1])
    table, path = None, None
    for sweep in range(burn_in + samples):
        shared, sampled, last = spark.sparkContext.broadcast(m), sweep >= burn_in, sweep + 1 == burn_in + samples

        def run(batches: Iterator[pa.RecordBatch], sweep=sweep, sampled=sampled, last=last, shared=shared) -> Iterator[pa.RecordBatch]:
            m = shared.value
            for number, rows in in_turn(arrow_rows(batches)):
                around = None
                if not sweep:
                    cut_up = ((longer(*p[:3]), unfolded(p[3], p[4]), p[5]) for p in (unpack(row.data) for row in rows))
                    block = first_block(cut_up)
                    del cut_up
                else:
                    row = next(rows)
                    block = Block.unpack(row.data)
                    around, *live = block.heard(m, row.replies, 2 if sweep == 1 else 1, sweep > 1)
                    del row
                    block.live = (live[0] > 0).astype(np.uint8) if live else block.live
                release()
                block, about = block.swept(m, np.random.default_rng([seed, 2, sweep, number]), sampled, passes, around)
                told, data = block.told(m, not sweep, last), block.pack()
                del block, around
                yield arrow_batch(SWEPT, (number, data, about, [{"home": h, "data": d} for h, d in told]))
                del told, data, about
                release()

        rows = table.select("block", "data", "replies") if table is not None else packed_pairs(cuts, shared).repartition(m.blocks, "block").sortWithinPartitions("block")
        new, new_path = in_buckets(rows.mapInArrow(run, "block int, data binary, about binary, told array<struct<home: int, data: binary>>"), m.blocks)
        if path:
            remove(spark, path)
        table, path = new, new_path
        tables, customers, (inside, rare_tables) = totals(table, len(h))
        parents = m.seat_parent(customers, parents, draw, passes)
        m = replace(m, tables=tables, customers=int(customers.sum()) + inside, shared=int(parents.t.sum()) + rare_tables, samples=list(m.samples))
        m.head = m.parent(customers, parents.t)
        if sampled:
            m.samples.append((m.tables, m.head, m.customers, m.shared))
        written, table = table, with_replies(table, m.blocks)
        shared.unpersist()
    hot = hot_pairs(written, spark.sparkContext.broadcast(m))
    m.pairs, m.p = hot["pair"].to_numpy(np.int64), hot["p"].to_numpy()
    return m, table.select("block", "data", "replies"), words


def in_buckets(blocks: DataFrame, buckets: int) -> tuple[DataFrame, str]:
    """Blocks written to the shared folder and read back, dealt by their number as they were written. The catalog names the table only meanwhile."""
    spark, path = blocks.sparkSession, shared_path(blocks.sparkSession, "lm-blocks")
    name = path.rpartition("/")[2].replace("-", "_")
    blocks.write.bucketBy(buckets, "block").option("path", path).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table, path


def with_replies(table: DataFrame, buckets: int) -> DataFrame:
    """Each block with the replies of the homes to what it told them: sums over all blocks, in the order of the homes."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for home, rows in by_block(batches):
            senders, parts = zip(*((row.sender, unpack(row.data)) for row in rows))
            far, _ = runs(np.sort(np.concatenate([p[0] for p in parts])))
            at = [found_at(far, p[0]) for p in parts]
            sums = [np.bincount(np.concatenate(at), np.concatenate(own), len(far)).astype(np.int64) for own in list(zip(*parts))[1:]]
            yield pd.DataFrame({"block": senders, "home": home, "data": [pack(*[x[a] for x in sums]) for a in at]})

    told = table.select(F.col("block").alias("sender"), F.explode("told").alias("told")).select(F.col("told.home").alias("block"), "sender", F.col("told.data").alias("data"))
    replies = told.repartition(buckets, "block").sortWithinPartitions("block").mapInPandas(run, "block int, home int, data binary")
    replies = replies.repartition(buckets, "block").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("home", "data"))).alias("replies")).select("block", F.col("replies.data").alias("replies"))
    return table.join(replies, "block", "left").withColumn("replies", F.coalesce("replies", F.array().cast("array<binary>")))


def totals(table: DataFrame, heads: int) -> tuple[np.ndarray, np.ndarray, tuple[int, int]]:
    """Tables of each context, the parent's customers of each frequent word, and its customers and tables of all rare ones: sums over the blocks."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["about"]:
                contexts, n, words, customers, rest = unpack(data)
                yield pd.DataFrame({"kind": np.repeat([0, 1, 2], [len(contexts), len(words), 2]), "i": np.r_[contexts, words, [0, 1]], "n": np.r_[n, customers, rest]})

    found = table.select("about").mapInPandas(run, "kind int, i long, n long").groupBy("kind", "i").agg(F.sum("n").alias("n")).toPandas()  # at most 2 HEAD rows
    out = [np.zeros(size, np.int64) for size in (heads + 1, heads, 2)]
    for kind, own in found.groupby("kind"):
        out[kind][own["i"].to_numpy(np.int64)] = own["n"].to_numpy(np.int64)
    return out[0].astype(float), out[1], (int(out[2][0]), int(out[2][1]))


def hot_pairs(blocks: DataFrame, shared) -> pd.DataFrame:
    """(pair, p) of the pairs that alone are frequent, at most ``HEAD``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for batch in batches:
            for data in batch["data"]:
                block = Block.unpack(data)
                hot = np.flatnonzero((block.n * m.share >= m.tokens) & frequent(block.word) & (block.context < WIDTH))
                yield pd.DataFrame({"pair": block.word[hot] * WIDTH + block.context[hot], "p": Predictions(block, m).of(block.word[hot], block.context[hot])})

    return blocks.mapInPandas(run, "pair long, p double").toPandas().sort_values("pair")


def score(df: DataFrame, model: Model, blocks: DataFrame) -> DataFrame:
    """(key, n_tokens, n_known, base_score, score) of each row (key, text)."""
    return score_tokens(tokenized(df.select("key", "text", F.lit(False).alias("learned"))), model, blocks, df.schema["key"].dataType)


def score_tokens(cuts: DataFrame, model: Model, blocks: DataFrame, key) -> DataFrame:
    """The same from documents as ``tokenized`` has cut them; ``key`` is the type of their keys.

    What a chunk needs of a block is one packed row, and so are the sums that come back: a document's pairs are not rows anywhere.
    """
    spark = cuts.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def sent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        tokens = np.r_[m.counts[:-1], 0]
        tokens[:-1][m.words == END] = m.counts[-1]
        for batch in batches:
            for row in batch.itertuples(index=False):
                lengths, learned, ids, h = cut(row.data)
                word, context, doc, n = distinct_items(lengths, ids, m.coded(h), m.start, np.repeat(np.arange(len(lengths)), lengths), len(lengths))
                common = frequent(word)
                base = np.where(common, np.log10((tokens[np.where(common, word, -1)] + 1) / (m.tokens + m.known + 1)), 0.0)
                at = found_at(m.pairs, np.where(common & frequent(context), word * WIDTH + context, -1))
                done = at >= 0
                apart = ~common & ~frequent(context) & ~learned[doc]  # no block knows the pair's word and its context, unless the pair is learned
                own = pack(lengths, np.bincount(doc, common * n, len(lengths)).astype(np.int64), np.bincount(doc, base * n, len(lengths)).astype(float),
                           np.bincount(doc[done], np.log10(m.p[at[done]]) * n[done], len(lengths)).astype(float), doc[apart], n[apart])
                yield pd.DataFrame({"block": [int(m.numbered(mixed(np.array([row.chunk], np.uint64)))[0])], "kind": [1], "chunk": [row.chunk], "data": [own], "keys": [row.keys]})
                rest, apart = ~done & ~apart, np.flatnonzero(apart)
                packed = [(b, 2, pack(*shorter(w), *folded(c), *x)) for b, (w, c, *x) in in_blocks(m.block(word, context)[rest], word[rest], context[rest], doc[rest], n[rest])]
                word, context, doc, n, number = word[apart], context[apart], doc[apart], n[apart], np.arange(len(apart))
                packed += [(b, 3, pack(*shorter(w), *folded(c), *x)) for b, (w, c, *x) in in_blocks(m.block(word, word), word, context, doc, n, number)]
                order = np.argsort(context)
                packed += [(b, 4, pack(*shorter(c), x)) for b, (c, x) in in_blocks(m.block(context, context)[order], context[order], number[order])]
                if packed:
                    yield pd.DataFrame(packed, columns=["block", "kind", "data"]).assign(chunk=row.chunk, keys=[[] for _ in packed])[["block", "kind", "chunk", "data", "keys"]]
                del word, context, doc, n, at, done, rest, apart, packed, order
                release()

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for _, rows in in_turn(arrow_rows(batches)):
            known = Predictions(first_block([]), m)
            for row in rows:
                found = []
                if row.kind == 0:
                    known = Predictions(Block.unpack(row.data), m, row.replies)
                elif row.kind == 1:
                    yield arrow_batch(FOUND, (row.chunk, 1, row.data.to_pybytes(), row["keys"]))
                elif row.kind == 4:
                    *context, number = unpack(row.data)
                    place = known.place(longer(*context))
                    found = [(4, pack(number, known.customers[place], *[t[place] for t in known.tables]))]
                else:
                    times, steps, hashes, context, far, doc, n, *number = unpack(row.data)
                    word, context = longer(times, steps, hashes), unfolded(context, far)
                    docs = np.flatnonzero(np.bincount(doc))
                    c = known.count(word)
                    base = np.where(frequent(word), 0.0, np.log10((c + 1) / (m.tokens + m.known + 1)) * n)
                    scores = np.log10(known.of(word, context)) * n if row.kind == 2 else np.zeros(len(word))
                    sums = [np.bincount(doc, v)[docs] for v in ((c > 0) * n, base, scores)]
                    found = [(2, pack(docs, sums[0].astype(np.int64), *sums[1:]))]
                    if row.kind == 3:
                        words, times = runs(word)
                        at = np.repeat(np.arange(len(words)), times)
                        found.append((3, pack(*number, known.at_tables(words, at, known.place(context)), *[p[at] for p in known.parents(words)])))
                for kind, data in found:
                    yield arrow_batch(FOUND, (row.chunk, kind, data, []))
            del known, row
            release()

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seatings = len(shared.value.samples)
        for _, rows in by_block(b.rename(columns={"chunk": "block"}) for b in batches):
            for row in rows:
                if row.kind == 1:
                    keys, (lengths, *sums, doc, n) = row.keys, unpack(row.data)
                    sums = [s.copy() for s in sums]
                    above, around = np.zeros((1 + seatings, len(doc))), np.zeros((1 + seatings, len(doc)))
                elif row.kind == 2:
                    docs, *more = unpack(row.data)
                    for total, one in zip(sums, more):
                        total[docs] += one
                else:
                    number, *parts = unpack(row.data)
                    (above if row.kind == 3 else around)[:, number] = parts
            sums[2] += np.bincount(doc, np.log10(averaged(above[0], above[1:], around[0], around[1:])) * n, len(lengths))
            yield pd.DataFrame({"key": keys, "n_tokens": lengths, "n_known": sums[0], "base_score": sums[1], "score": sums[2]})

    items = cuts.mapInPandas(sent, "block int, kind int, chunk long, data binary, keys array<string>").withColumn("replies", F.array().cast("array<binary>"))
    model_rows = blocks.select("block", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("chunk"), "data", F.array().cast("array<string>").alias("keys"), "replies")
    sums = model_rows.unionByName(items).repartition(model.blocks, "block").sortWithinPartitions("block", "kind").mapInArrow(looked_up, "chunk long, kind int, data binary, keys array<string>")
    out = sums.repartition("chunk").sortWithinPartitions("chunk", "kind").mapInPandas(added, "key string, n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("key", F.col("key").cast(key))


def evaluate(df: DataFrame, learned: Column, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score) of each row; rows where ``learned`` holds are learned from.

    Words are separated by ASCII white space, A-Z in lower case; an end follows the last one and is a token. ``score`` is the base-10 logarithm of
    the averaged predictive probability of the tokens, ``base_score`` that of add-one smoothed shares of all tokens, ``n_known`` how many tokens
    were learned. A null text counts as an empty one: the end alone. Repeated rows have their row each and are learned as often; keys
    may be null or repeat. An empty table stays empty; without a learned row everything is unknown. Whole texts are
    scored; words are 64-bit hashes. Other columns are dropped. The same seed and table give the same seating, whatever the partitions.
    """
    let_workers_import(df.sparkSession)
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"), F.coalesce(learned, F.lit(False)).alias("learned"))
    cuts, _ = stash(tokenized(rows), "lm-tokens")
    model, blocks, _ = fit_tokens(cuts, **how)
    out = score_tokens(cuts, model, blocks, rows.schema["key"].dataType)
    return out.select(F.col("key").alias(key), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
