"""Grouping of spelling variants through pairs of trie nodes.

Words are kept in two tries, one of the words and one of the words reversed, whose nodes are numbered. A word cut anywhere is a pair of
numbers, the node of what stands before the cut and the node of what stands after it. A pair around one skipped position says all of a word but
that position: two words share such a pair exactly if they differ by one replaced code point there. A pair around a skipped
position of one word equals a pair at a cut of another exactly if the former has one more code point there. So one shuffle of integer
pairs finds all words one edit apart, and no strings are compared.

Nodes are numbered in sorted order, in which the words below a node stand together: tasks take ranges of sorted words, number the nodes of
their own part, and the nodes that a range shares with the one before are renamed to the earlier number. No node is a shuffle key while it is
numbered, so a prefix of very many words is no single task's work. At most one word has a given cut pair, and at most as
many words share a skip pair as there are letters.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import let_workers_import, remove, stash

# fixed values: letters, the rule of deletions, the limits of words and forms
LETTERS, EVERY = "A-Za-zÀ-ÿ", 199
LEAST_LENGTH, LEAST_COUNT, FORM_TIMES = 6, 5, 5
#: Distinct words that a task counts before it passes them on.
HELD = 200_000


def lower_ascii(text: str) -> str:
    """A-Z in lower case, other letters as they are."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def words_of(doc_id, text: str | None, runs: re.Pattern, least: int, every: int) -> Iterator[tuple[str, int]]:
    """The words of a text and how often each occurs: runs of letters, one code point deleted where the check sum of document and run says so."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(runs.findall(lower_ascii(text or ""))).items():
        h = zlib.crc32(run.encode(), start)
        if h % every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < least:
                continue
        yield run, n


def count_words(df: DataFrame, key: str = "doc_id", text: str = "text", letters: str = LETTERS, least: int = LEAST_LENGTH, every: int = EVERY) -> DataFrame:
    """(word, n) of all words of at least ``least`` code points; tasks add up what they hold before it is shuffled."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs, held = re.compile(f"[{letters}]{{{least},}}"), Counter()
        for batch in batches:
            for doc, t in zip(batch["key"], batch["text"]):
                for word, n in words_of(doc, t, runs, least, every):
                    held[word] += n
                if len(held) >= HELD:
                    yield pd.DataFrame({"word": list(held), "n": list(held.values())})
                    held.clear()
        if held:
            yield pd.DataFrame({"word": list(held), "n": list(held.values())})

    rows = df.select(F.col(f"`{key}`").cast("string").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInPandas(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def numbered_nodes(words: DataFrame, column: str, name: str) -> tuple[DataFrame, dict[int, int], str]:
    """(id, nodes) of each word, the numbers of the trie nodes from the root (0) to the whole word; the nodes to rename; and the table's path.

    Ranges of sorted words are numbered each by one task, from the number of its partition on. Where a range begins inside subtrees of the
    range before, the nodes are the same, and the later numbers are renamed: at most a word's length of them for each partition.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        last, path, free = "", [0], (part << 40) + 1
        for batch in batches:
            out = []
            for word in batch["word"]:
                same = common_prefix(last, word)
                new = len(word) - same
                path = path[:same + 1] + list(range(free, free + new))
                free += new
                last = word
                out.append(path)
            yield pd.DataFrame({"id": batch["id"], "nodes": out, "word": batch["word"], "part": part})

    ordered = words.select("id", F.col(column).alias("word")).repartitionByRange("word").sortWithinPartitions("word")
    table, path = stash(ordered.mapInPandas(run, "id long, nodes array<long>, word string, part int"), name)
    ends = table.groupBy("part").agg(F.min(F.struct("word", "nodes")).alias("first"), F.max(F.struct("word", "nodes")).alias("last")).orderBy("part").collect()  # a row a partition
    renamed: dict[int, int] = {}
    for before, after in zip(ends, ends[1:]):
        same = common_prefix(before["last"]["word"], after["first"]["word"])
        for old, new in zip(after["first"]["nodes"][1:same + 1], before["last"]["nodes"][1:same + 1]):
            renamed[old] = renamed.get(new, new)
    return table.select("id", "nodes"), renamed, path


def common_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def pairs(words: DataFrame, forward: tuple[DataFrame, dict[int, int]], backward: tuple[DataFrame, dict[int, int]]) -> DataFrame:
    """(p, s, cut, first, id): every word's pairs at cuts, and around skipped positions; ``first`` marks the first position of equal neighbours."""
    old, new = ([np.array([n[i] for n in sorted(renamed.items())], np.int64) for _, renamed in (forward, backward)] for i in (0, 1))

    def settled(nodes: np.ndarray, side: int) -> np.ndarray:
        if not len(old[side]):
            return nodes
        at = np.minimum(np.searchsorted(old[side], nodes), len(old[side]) - 1)
        return np.where(old[side][at] == nodes, new[side][at], nodes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 2000):
                some = batch.iloc[at:at + 2000]
                length = some["word"].str.len().to_numpy()
                p, s = settled(np.concatenate(some["forward"].to_numpy()), 0), settled(np.concatenate([x[::-1] for x in some["backward"]]), 1)
                code = np.concatenate([np.frombuffer((w + "\0").encode("utf-32-le", "surrogatepass"), np.uint32) for w in some["word"]])
                ids = np.repeat(some["id"].to_numpy(), length + 1)
                skip = np.ones(len(ids), bool)
                skip[np.cumsum(length + 1) - 1] = False  # behind the last code point nothing can be skipped
                begins = np.r_[0, np.cumsum(length + 1)[:-1]]
                first = np.r_[True, code[1:] != code[:-1]]
                first[begins] = True
                over = np.flatnonzero(skip)
                yield pd.DataFrame({"p": np.r_[p, p[over]], "s": np.r_[s, s[over + 1]], "cut": np.r_[np.ones(len(p), bool), np.zeros(len(over), bool)],
                                    "first": np.r_[np.zeros(len(p), bool), first[over]], "id": np.r_[ids, ids[over]]})

    both = words.select("id", "word").join(forward[0].select("id", F.col("nodes").alias("forward")), "id").join(backward[0].select("id", F.col("nodes").alias("backward")), "id")
    return both.mapInPandas(run, "p long, s long, cut boolean, first boolean, id long")


def neighbours(pair_rows: DataFrame) -> DataFrame:
    """(id, n_near, best): how many words are one edit from each, and the smallest id among them.

    In the rows of a pair every skip but a word's own is a replacement; a skip and the cut are a deletion and an insertion, counted at
    the first position of equal neighbours only, as the others delete to the same word.
    """
    same = Window.partitionBy("p", "s")
    ordered = same.orderBy("cut", "id")  # skips before the cut
    rows = pair_rows.withColumns({
        "skips": F.count_if(~F.col("cut")).over(same), "lowest": F.min(F.when(~F.col("cut"), F.col("id"))).over(same),
        "whole": F.max(F.when(F.col("cut"), F.col("id"))).over(same),
        "longer": F.count_if("first").over(same), "longest": F.min(F.when(F.col("first"), F.col("id"))).over(same),
        "next": F.lead(F.when(~F.col("cut"), F.col("id"))).over(ordered)})
    other = F.when(F.col("id") == F.col("lowest"), F.col("next")).otherwise(F.col("lowest"))
    shorter = F.when(F.col("first"), F.col("whole"))
    n = F.when(F.col("cut"), F.col("longer")).otherwise(F.col("skips") - 1 + shorter.isNotNull().cast("int"))
    best = F.when(F.col("cut"), F.col("longest")).otherwise(F.least(other, shorter))
    return rows.select("id", n.alias("n"), best.alias("best")).where("n > 0").groupBy("id").agg(F.sum("n").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(id, root) of the words with a form, from (id, form): forms are followed by doubling the steps until none leads on."""
    table, path = stash(forms.select("id", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = table.join(table.select(F.col("id").alias("root"), F.col("root").alias("on")), "root", "left")
        new, new_path = stash(step.select("id", F.coalesce("on", "root").alias("root"), F.col("on").isNotNull().alias("moved")), "spelling-roots")
        remove(forms.sparkSession, path)
        table, path = new.drop("moved"), new_path
        if new.where("moved").isEmpty():
            return table


def group(df: DataFrame, key: str = "doc_id", text: str = "text", letters: str = LETTERS, least: int = LEAST_LENGTH, often: int = LEAST_COUNT,
          times: int = FORM_TIMES, every: int = EVERY) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of at least ``least`` code points with ``often`` occurrences or more.

    Two words are near if one inserted, deleted or replaced code point makes one the other. A word's form is the near word with the most
    occurrences, of several the first in code point order, if it has at least ``times`` as many; else null. ``root`` follows the forms to the last.

    A null text has no words; a null key counts as an empty one in the check sums. Every row counts, repeated rows each. An empty table
    has no words. Other columns are dropped. Letters are matched in whole texts; very long runs are words like others.
    """
    if times <= 1:
        raise ValueError("forms must occur more often than their words, else they lead in circles")
    let_workers_import(df.sparkSession)
    counted = count_words(df, key, text, letters, least, every).where(F.col("n") >= often)
    # numbers by falling count and code points: the best of some words is that of the smallest number
    words, words_path = stash(counted.orderBy(F.col("n").desc(), "word").withColumn("id", F.monotonically_increasing_id()).withColumn("reversed", F.reverse("word")), "spelling-words")
    forward, backward = numbered_nodes(words, "word", "spelling-forward"), numbered_nodes(words, "reversed", "spelling-backward")
    near, near_path = stash(neighbours(pairs(words, forward[:2], backward[:2])), "spelling-near")
    named = lambda p: words.select(F.col("id").alias(p), F.col("word").alias(f"{p}_word"), F.col("n").alias(f"{p}_n"))
    with_best = words.select("id", "word", "n").join(near, "id", "left").join(named("best"), "best", "left")
    with_form, form_path = stash(with_best.withColumn("form", F.when(F.col("best_n") >= times * F.col("n"), F.col("best"))), "spelling-forms")
    root, _ = stash(roots(with_form.where("form IS NOT NULL").select("id", "form")).join(named("root"), "root").select("id", "root_word"), "spelling-named")
    out, _ = stash(with_form.join(root, "id", "left").select("word", F.when(F.col("form").isNotNull(), F.col("best_word")).alias("form"), F.coalesce("root_word", "word").alias("root"), "n",
                                                           F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n")), "spelling")
    remove(df.sparkSession, words_path, forward[2], backward[2], near_path, form_path)
    return out
