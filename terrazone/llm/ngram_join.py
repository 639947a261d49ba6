"""Self-join of documents by the Jaccard similarity of their word n-grams, through a token-group matrix.

A document is the set of its hashed n-grams (tokens). Similar documents are first partitioned into groups: those that share
several minimum hashes with the leader of their bucket. Where an exact comparison with the leader shows a link at once, the two are one
component. A group that is not one component yet is compared inside, in blocks of bounded size. A group's row of the
matrix is the union of its members' tokens. A document can only link with a member of another group if that union holds the
required overlap, so the overlap of document and union decides whether the group is opened, that is whether its members are
compared with the document one by one.

Pairs of groups that share nothing are never formed. The hash space is cut into more parts than two linked documents
can have different tokens, so that linked documents agree on whole parts; only groups that agree on a part meet. The
number of parts follows from the size of the larger document, for which documents are put into size classes; documents too small for
parts meet on single tokens. Parts are made of the
tokens that are not frequent, as frequent ones would let unrelated documents agree; documents with hardly any others list parts of all their tokens
as well. Which tokens count as frequent, and which leaders are tried, changes the work and not the result.

A part that very many groups agree on does not pair them. They are put together into one larger group, whose row of the matrix says in how many
components each token occurs: a document all but a few of whose tokens have to be shared with another component, and are not, has no link
left and drops out; the rest is compared in blocks. So the pairs that a part forms are bounded, and a large group costs what its tokens cost and
the square of those members alone that the matrix cannot rule out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from .blocks import blocked, by_groups, near_components, opposite, streamed
from .common import bounded_sample, having, let_workers_import, remove, stash
from .components import connected_components
from .sampled_pieces import mixed

#: Minimum hashes whose buckets name a leader each; how many of them two documents share that are put into one group.
LEADERS, ALIKE = 6, 3
#: Documents of the sample in which frequent tokens are sought; documents of it that have a frequent token; frequent tokens at most.
SAMPLE, OFTEN, MOST = 5000, 3, 1 << 16
#: Documents of a group that are compared in one piece, and tokens that are compared at once.
BLOCK, COLUMNS = 512, 8192
#: Groups that agree on a part and are paired at most; beyond that they become one. Rounds in which the matrix thins out large groups.
PAIRED, ROUNDS = 16, 2
#: Slices of the hash space at most in which the tokens of a large group's pieces meet.
SLICES = 1024
#: Parts of the hash space in which a set's tokens are counted, for a bound of what two sets have in common.
SKETCH = 128
SALT = np.uint64(0x9E3779B97F4A7C15)
#: Characters of text that are made into sets at once.
CHUNK = 1 << 20


class Shapes:
    """What the threshold implies: size classes, the largest difference of linked sets, and the number of parts."""

    def __init__(self, percent: int):
        if not 50 <= percent <= 100:
            raise ValueError("the threshold must lie between 50 and 100 percent")
        upper = [1]
        while upper[-1] < 1 << 40:
            upper.append(max(upper[-1] + 1, upper[-1] * 100 // percent))
        self.percent, self.upper = percent, np.array(upper)
        self.differ = 2 * self.upper * (100 - percent) // (100 + percent)

        self.chosen: dict[int, tuple[int, int] | None] = {}

    def parts(self, c: int) -> tuple[int, int] | None:
        """Parts for the class of the larger set, and how many of them may be empty without being listed.

        The latter leaves room for the empty parts of nearly all sets that use the class, of which the smallest are two classes below. None
        where parts would hold too few tokens for that.
        """
        if c not in self.chosen:
            differ, least, spare = int(self.differ[c]), int(self.upper[max(c - 2, 0)]), 1
            for _ in range(60):
                n = differ + 1 + spare
                empty = n * math.exp(-least / n)
                wanted = 1 + math.ceil(empty + 4 * math.sqrt(empty))
                if wanted <= spare or spare > differ // 2 + 2:
                    break
                spare = wanted
            self.chosen[c] = (differ + 1 + spare, spare) if spare <= differ // 2 + 2 else None
        return self.chosen[c]

    def signatures(self, tokens: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, int]:
        """Hashes, and on how many of them a set that links agrees at least; for a set's own class and for the next, in which a larger set may be.

        Two linked sets agree on all parts but as many as they differ in tokens: on more parts than ``spare``. That also holds for the parts of
        the tokens outside any fixed list. At most as many of these are empty as either of the two has empty parts, so that all above that, one at
        least if one has no more empty parts than ``spare``, are not. A set with more
        empty ones lists, in a second family, the parts of all its tokens, and the empty ones among those if these are still more than ``spare``.
        Small sets have no parts; they list their first tokens in one order of all tokens, frequent ones last, as many as cannot all be missing in a set that
        links. Sets of a class in which links allow no difference list nothing, as equal sets are one already.
        """
        own = int(np.searchsorted(self.upper, len(tokens)))
        often = frequent[np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)] == tokens if len(frequent) else np.zeros(len(tokens), bool)
        found, small, least = [], False, []
        for c in (own, own + 1):
            if not self.differ[c]:
                continue
            if self.parts(c) is None:
                small = True
                continue
            n, spare = self.parts(c)
            parts, content = self.listed(tokens[~often], n)
            found.append(mixed(content + mixed(np.uint64((2 * c + 1) << 32) + parts)))
            least.append(max(1, 1 + spare - (n - len(parts))))
            if n - len(parts) > spare:
                parts, content = self.listed(tokens, n)
                if n - len(parts) > spare:
                    empty = np.setdiff1d(np.arange(n, dtype=np.uint64), parts)
                    parts, content = np.r_[parts, empty], np.r_[content, np.zeros(len(empty), np.uint64)]
                found.append(mixed(content + mixed(np.uint64((2 * c) << 32) + parts)))
        if small:
            first = len(tokens) - -(-self.percent * len(tokens) // 100) + 1
            found.append(mixed(tokens[np.lexsort((mixed(tokens ^ SALT), often))][:first] + SALT))
            least.append(1)
        return (np.concatenate(found).view(np.int64), min(least)) if found else (np.zeros(0, np.int64), 1)

    @staticmethod
    def listed(tokens: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The parts, of n, that hold a token, and a hash of the content of each."""
        if not len(tokens):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        part = mixed(tokens ^ SALT) % np.uint64(n)
        order = np.argsort(part, kind="stable")
        begins = np.flatnonzero(np.r_[True, np.diff(part[order].astype(np.int64)) != 0])
        return part[order[begins]], np.add.reduceat(mixed(tokens[order] + SALT), begins)


class Seen(dict):
    """Numbers of words in the order of their first occurrence."""

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return self[word]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word of the texts, one after another, and the number of words of each text; a distinct word is hashed once."""
    words, seen = [t.split() for t in texts], Seen()  # of bytes: at ASCII white space
    counts = np.fromiter(map(len, words), np.int64, len(words))
    number = np.fromiter((seen[w] for ws in words for w in ws), np.int64, int(counts.sum()))
    return np.fromiter(map(xxhash.xxh3_64_intdigest, seen), np.uint64, len(seen))[number], counts


def chained(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n neighbouring word hashes."""
    token = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        token = mixed(token * SALT + h[k:len(h) - n + 1 + k])
    return token


def token_sets(texts: list[str | None], size: int) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of each whole text's n-grams of words, A-Z in lower case; fewer words than ``size`` are one token."""
    at = 0
    while at < len(texts):
        end, held = at, 0
        while end < len(texts) and (held < CHUNK or end == at):
            held += len(texts[end] or "")
            end += 1
        h, counts = word_hashes([(t or "").encode("utf-8", "surrogatepass").lower() for t in texts[at:end]])  # bytes: A-Z alone
        windows = chained(h, size) if len(h) >= size else h[:0]
        first = 0
        for n in counts.tolist():
            token = np.sort(windows[first:first + n - size + 1] if n >= size else chained(h[first:first + n], n) if n else h[:0])
            yield token[np.r_[True, token[1:] != token[:-1]]] if len(token) > 1 else token
            first += n
        at = end


def profiles(docs: DataFrame, size: int, percent: int, leaders: int, frequent) -> DataFrame:
    """(doc, n, h1, h2, mins, least): size of each row's set, a 128-bit hash of it, its minimum hashes, and on how many signatures a linked set agrees at least."""
    salts = mixed(np.arange(1, leaders + 1, dtype=np.uint64))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shapes = Shapes(percent)
        for batch in batches:
            rows = []
            for t in token_sets(batch["text"].tolist(), size):
                h = (mixed(t).sum(dtype=np.uint64), mixed(t ^ SALT).sum(dtype=np.uint64))
                rows.append((len(t), *np.array(h, np.uint64).view(np.int64), [mixed(t ^ s).min().view(np.int64) for s in salts] if len(t) else [], shapes.signatures(t, frequent.value)[1]))
            yield pd.DataFrame({"doc": batch["doc"], **{c: [r[i] for r in rows] for i, c in enumerate(("n", "h1", "h2", "mins", "least"))}})

    return docs.mapInPandas(run, "doc long, n long, h1 long, h2 long, mins array<long>, least int")


def frequent_tokens(docs: DataFrame, size: int) -> np.ndarray:
    """The tokens of several documents of a bounded sample, a bounded number of them, sorted."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for t in token_sets(batch["text"].tolist(), size):
                yield pd.DataFrame({"token": t.view(np.int64)})

    tokens = bounded_sample(docs.where(F.col("text").isNotNull()), ["doc", "text"], SAMPLE).mapInPandas(run, "token long")
    often = tokens.groupBy("token").count().where(F.col("count") >= OFTEN).orderBy(F.col("count").desc(), "token").limit(MOST)
    return np.sort(often.toPandas()["token"].to_numpy(np.int64).view(np.uint64))


def signature_rows(docs: DataFrame, size: int, percent: int, frequent) -> DataFrame:
    """(sig, doc) of all parts of all named documents; equal sets of a batch are listed once."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shapes = Shapes(percent)
        for batch in batches:
            seen, rows, held = set(), [], 0
            for doc, t in zip(batch["doc"], token_sets(batch["text"].tolist(), size)):
                if not len(t) or (name := t.tobytes() if len(t) < 8 else xxhash.xxh3_128_digest(t.tobytes())) in seen:
                    continue
                seen.add(name)
                s, _ = shapes.signatures(t, frequent.value)
                rows.append((s, doc))
                held += len(s)
                if held > 200_000:
                    yield frame(rows)
                    rows, held = [], 0
            if rows:
                yield frame(rows)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame({"sig": np.concatenate([s for s, _ in rows]), "doc": np.repeat(np.array([d for _, d in rows], np.int64), [len(s) for s, _ in rows])})

    return docs.where(F.col("doc").isNotNull()).mapInPandas(run, "sig long, doc long")


def may_be_as_large(n: Column, low: Column, high: Column, percent: int) -> Column:
    """Whether a set of n tokens can link with one of between ``low`` and ``high`` tokens."""
    return (n * percent <= high * 100) & (low * percent <= n * 100)


def linked_by_text(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that link, from the whole texts of both."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = dict(zip(batch["a"], batch["ta"])) | dict(zip(batch["b"], batch["tb"]))
            sets = dict(zip(texts, token_sets(list(texts.values()), size)))
            keep = []
            for a, b in zip(batch["a"], batch["b"]):
                x, y = sets[a], sets[b]
                common = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.loc[keep, ["a", "b"]]

    docs = having(docs, "doc", pairs.select(F.explode(F.array("a", "b")).alias("doc")))  # hardly any other text is shuffled
    first = pairs.join(docs.select(F.col("doc").alias("a"), F.col("text").alias("ta")), "a")
    return first.join(docs.select(F.col("doc").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb").mapInPandas(run, "a long, b long")


def leader_pairs(reps: DataFrame) -> tuple[DataFrame, str]:
    """(a, an, b, bn, shared): each set, the leader of a bucket of minimum hashes that it is in, and how many buckets name that leader for it; and the leaders' path."""
    rows = reps.select("doc", "n", F.posexplode("mins").alias("k", "m"))
    leaders, path = stash(rows.groupBy("k", "m").agg(F.min(F.struct(F.xxhash64("doc").alias("h"), "doc", "n")).alias("lead"), F.count(F.lit(1)).alias("rows"))
                       .where("rows > 1").select("k", "m", F.col("lead.doc").alias("b"), F.col("lead.n").alias("bn")), "leaders")
    near = rows.join(leaders, ["k", "m"]).where(F.col("doc") != F.col("b"))
    return near.groupBy(F.col("doc").alias("a"), F.col("n").alias("an"), "b", "bn").agg(F.count(F.lit(1)).alias("shared")), path


def group_meetings(docs: DataFrame, members: DataFrame, size: int, percent: int, frequent) -> tuple[DataFrame, DataFrame, str]:
    """(g, h) of different groups whose members agree on as many parts as those of any linked members must, g the smaller id; (g, lead) of groups
    that agree on a part with very many others; and the path of what both are read from.

    ``members`` has doc, g and least of every document. Each part pairs at most ``PAIRED`` groups.
    """
    by_doc, by_sig = Window.partitionBy("sig").orderBy("doc"), Window.partitionBy("sig")
    shared = (signature_rows(docs, size, percent, frequent).withColumns({"before": F.lag("doc").over(by_doc), "after": F.lead("doc").over(by_doc)})
              .where((F.col("before") != F.col("doc")) | (F.col("after") != F.col("doc"))).select("sig", "doc"))
    rows = shared.join(members.select("doc", "g", "least"), "doc").select("sig", "g", "least")
    rows = rows.withColumns({"low": F.min("g").over(by_sig), "high": F.max("g").over(by_sig)}).where("low < high").groupBy("sig", "low", "g").agg(F.min("least").alias("least"))
    rows, path = stash(rows.withColumn("groups", F.count(F.lit(1)).over(by_sig)), "parts")
    few = rows.where(F.col("groups") <= PAIRED).select("sig", "g", "least")
    met = few.join(few.select("sig", F.col("g").alias("h"), F.col("least").alias("h_least")), "sig").where("g < h")
    agreed = met.groupBy("g", "h").agg(F.count(F.lit(1)).alias("agreed"), F.min("least").alias("least"), F.min("h_least").alias("h_least"))
    # parts of many groups do not count here, so one that two documents agree on may be missing: those groups meet in the larger one as well
    many = rows.where(F.col("groups") > PAIRED).select("g", F.col("low").alias("lead")).distinct()
    return agreed.where(F.col("agreed") >= F.greatest("least", "h_least")).select("g", "h"), many, path


def sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> tuple[DataFrame, str]:
    """(doc, tokens, counts) of the wanted documents, as a table: their sets, and how many tokens fall into each part of the hash space."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                some = batch.iloc[at:at + 500]
                sets = list(token_sets(some["text"].tolist(), size))
                yield pd.DataFrame({"doc": some["doc"], "tokens": [t.view(np.int64) for t in sets], "counts": [np.bincount((t % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH).astype(np.int32) for t in sets]})

    return stash(having(docs, "doc", wanted).mapInPandas(run, "doc long, tokens array<long>, counts array<int>").dropDuplicates(["doc"]), "sets")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Common tokens of all pairs of sets; only tokens of several sets are looked at, so many at once."""
    tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    known, column, often = np.unique(tokens, return_inverse=True, return_counts=True)
    use = often[column] > 1
    column, owner = (np.cumsum(often > 1) - 1)[column[use]], owner[use]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int((often > 1).sum()), COLUMNS):
        here = (column >= at) & (column < at + COLUMNS)
        m = np.zeros((len(sets), min(COLUMNS, int((often > 1).sum()) - at)), np.float32)
        m[owner[here], column[here] - at] = 1
        out += m @ m.T
    return out.astype(np.int64)


def links_inside_groups(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): every document of a group linked to the smallest that it reaches inside a pair of blocks."""
    def compare(group: pd.DataFrame) -> pd.DataFrame | None:
        group = group.sort_values("doc")
        n, c = group["n"].to_numpy(), group["c"].to_numpy()
        common = overlaps(list(group["tokens"]))
        linked = (common * (100 + percent) >= percent * (n[:, None] + n)) & opposite(group) & (c[:, None] != c)
        low = near_components(linked)
        far = low != np.arange(len(low))
        return pd.DataFrame({"a": group["doc"].to_numpy()[far], "b": group["doc"].to_numpy()[low[far]]}) if far.any() else None

    rows = blocked(members.select("g", "doc", "n", "c"), ["g"], "doc", BLOCK).join(sets.select("doc", "tokens"), "doc")
    return by_groups(rows, ["g"], compare, "a long, b long")


def links_between_groups(queries: DataFrame, targets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of linked documents in different groups, from queries (x, xn, g, rows, low): documents and the groups they met."""
    of_x, of_y = sets.select(F.col("doc").alias("x"), F.col("tokens").alias("tx")), sets.select(F.col("doc").alias("y"), F.col("tokens").alias("ty"))
    # the matrix, one row per token and group; a group of one member needs none, its bound is the comparison itself
    several = queries.where("rows > 1")
    matrix = targets.join(several.select("g").distinct(), "g", "left_semi").join(of_y, "y").select("g", F.explode("ty").alias("token")).distinct()
    asked = several.join(of_x, "x").select("x", "xn", "g", "low", F.explode("tx").alias("token"))
    bound = asked.join(matrix, ["g", "token"]).groupBy("x", "xn", "g", "low").agg(F.count(F.lit(1)).alias("overlap"))
    least = F.greatest(F.col("low"), F.ceil(F.col("xn") * percent / 100))
    opened = bound.where(F.col("overlap") * (100 + percent) >= percent * (F.col("xn") + least)).select("x", "xn", "g").unionByName(queries.where("rows = 1").select("x", "xn", "g"))
    pairs = opened.join(targets, "g").where(may_be_as_large(F.col("xn"), F.col("yn"), F.col("yn"), percent)).select("x", "xn", "y", "yn").distinct()
    # no two sets have more tokens in common than the smaller counts of the parts add up to; that rules most pairs out before sets are sent
    pairs = pairs.join(sets.select(F.col("doc").alias("x"), F.col("counts").alias("cx")), "x").join(sets.select(F.col("doc").alias("y"), F.col("counts").alias("cy")), "y")
    most = F.aggregate(F.zip_with("cx", "cy", lambda a, b: F.least(a, b)), F.lit(0), lambda a, n: a + n)
    pairs = pairs.where(most * (100 + percent) >= percent * (F.col("xn") + F.col("yn"))).drop("cx", "cy")
    common = F.size(F.array_intersect("tx", "ty"))
    return pairs.join(of_x, "x").join(of_y, "y").where(common * (100 + percent) >= percent * (F.col("xn") + F.col("yn"))).select(F.col("x").alias("a"), F.col("y").alias("b"))


def shared_tokens(rows: DataFrame) -> DataFrame:
    """(g, piece, tokens): those tokens of the piece of a group that are in several of the group's components, in some rows a piece.

    From rows (g, doc, n, c, pieces, piece, tokens). A piece sends each of its tokens once, with the smallest and largest of its components, in packed rows,
    one to each of as many slices of the hash space as the group has pieces; so what meets in a slice is about as much as a piece.
    """
    def sent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in streamed(batches, ["g", "piece"]):
            sizes = part["tokens"].map(len).to_numpy()
            tokens, c = np.concatenate(part["tokens"].to_list()), np.repeat(part["c"].to_numpy(), sizes)
            n = min(int(part["pieces"].iloc[0]), SLICES)
            known, low, high = by_token(tokens, c, c)
            at = (mixed(known.view(np.uint64) ^ SALT) % np.uint64(n)).astype(np.int64)
            rows = [(k, np.stack([a[at == k] for a in (known, low, high)])) for k in range(n)]
            rows = [(k, a) for k, a in rows if a.size]
            yield pd.DataFrame({"g": part["g"].iloc[0], "piece": part["piece"].iloc[0], "slice": [k for k, _ in rows], "data": [a.tobytes() for _, a in rows]})

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in streamed(batches, ["g", "slice"]):
            own = [np.frombuffer(d, np.int64).reshape(3, -1) for d in part["data"]]
            known, low, high = by_token(*np.concatenate(own, axis=1))
            shared = known[low < high]
            yield pd.DataFrame({"g": part["g"].to_numpy(), "piece": part["piece"].to_numpy(), "tokens": [np.intersect1d(a[0], shared, assume_unique=True) for a in own]})

    packed = by_key(rows, "g", "piece").mapInPandas(sent, "g long, piece int, slice int, data binary")
    return by_key(packed, "g", "slice").mapInPandas(compared, "g long, piece int, tokens array<long>")


def by_key(df: DataFrame, *keys: str) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys)


def by_token(tokens: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct tokens, sorted, and the smallest ``low`` and largest ``high`` of each."""
    order = np.argsort(tokens, kind="stable")
    tokens, low, high = tokens[order], low[order], high[order]
    begins = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]]) if len(tokens) else np.zeros(0, np.int64)
    return (tokens[begins], np.minimum.reduceat(low, begins), np.maximum.reduceat(high, begins)) if len(tokens) else (tokens, low, high)


def thinned(inside: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the rows (g, doc, n, c) of a group those that may link with another component of it, by the matrix row of the group.

    The matrix says which tokens of a group are in several of its components. A document that links has as many of them as the smallest overlap
    with a document that can link; without those that have fewer, further tokens may be in one component only. Groups of up to ``BLOCK`` documents are
    compared in one piece anyway and stay as they are; larger ones are looked at in pieces of about so many.
    """
    large = inside.groupBy("g").count().where(F.col("count") > BLOCK).select("g", F.ceil(F.col("count") / BLOCK).cast("int").alias("pieces"))
    rows, path = stash(inside.join(large, "g").withColumn("piece", F.pmod(F.xxhash64("doc"), F.col("pieces")).cast("int")), "large")
    paths = [path]

    def kept(keys: tuple, part: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
        known = np.sort(np.concatenate(shared["tokens"].to_list())) if len(shared) else np.zeros(0, np.int64)
        n = part["n"].to_numpy()
        overlap = np.array([len(np.intersect1d(t, known, assume_unique=True)) for t in part["tokens"]], np.int64)
        least = -(-n * percent // 100)
        return part.loc[overlap * (100 + percent) >= percent * (n + least), columns]

    columns, schema = rows.columns, rows.schema
    for _ in range(ROUNDS):
        own = rows.join(sets.select("doc", "tokens"), "doc").select(*columns, "tokens")
        shared = shared_tokens(own)
        rows, path = stash(own.groupBy("g", "piece").cogroup(shared.groupBy("g", "piece")).applyInPandas(kept, schema), "large")
        paths.append(path)
    remove(inside.sparkSession, *paths[:-1])
    return inside.join(large, "g", "left_anti").unionByName(rows.select(*inside.columns))


def remaining_links(docs: DataFrame, sizes: DataFrame, groups: DataFrame, components: DataFrame, size: int, percent: int, frequent) -> tuple[DataFrame, str]:
    """(a, b) of links between different components: enough to connect all that are linked at all; and the table's path."""
    spark = docs.sparkSession
    named = lambda t, c: t.select(F.col("node").alias("doc"), F.col("component").alias(c))
    members, members_path = stash(sizes.join(named(groups, "g"), "doc", "left").join(named(components, "c"), "doc", "left")
                                  .select("doc", "n", "least", F.coalesce("g", "doc").alias("g"), F.coalesce("c", "doc").alias("c")), "members")
    of = members.groupBy("g").agg(F.count(F.lit(1)).alias("rows"), F.min("n").alias("low"), F.max("n").alias("high"))
    side = lambda c, p: of.select(F.col("g").alias(c), *[F.col(x).alias(f"{p}_{x}") for x in ("rows", "low", "high")])
    met, many, parts_path = group_meetings(docs, members, size, percent, frequent)
    met = met.join(side("g", "g"), "g").join(side("h", "h"), "h")
    met = met.where((F.col("g_low") * percent <= F.col("h_high") * 100) & (F.col("h_low") * percent <= F.col("g_high") * 100))
    small_g = F.struct("g_rows", "g") < F.struct("h_rows", "h")
    pick = lambda a, b: F.when(small_g, F.col(a)).otherwise(F.col(b))
    met = met.select(pick("g", "h").alias("from"), pick("h", "g").alias("g"), pick("h_rows", "g_rows").alias("rows"), pick("h_low", "g_low").alias("low"), pick("h_high", "g_high").alias("high"))
    queries, queries_path = stash(met.join(members.select(F.col("g").alias("from"), F.col("doc").alias("x"), F.col("n").alias("xn")), "from")
                                  .where(may_be_as_large(F.col("xn"), F.col("low"), F.col("high"), percent)).select("x", "xn", "g", "rows", "low").distinct(), "queries")
    targets, targets_path = stash(members.join(queries.select("g").distinct(), "g", "left_semi").select("g", F.col("doc").alias("y"), F.col("n").alias("yn")), "targets")
    # the groups of a part of many are compared under the smallest of them, each group also by itself
    under = many.unionByName(members.select("g", F.col("g").alias("lead"))).distinct()
    larger = members.join(under, "g").select(F.col("lead").alias("g"), "doc", "n", "c")
    open_groups = larger.groupBy("g").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("g")
    inside, inside_path = stash(larger.join(open_groups, "g", "left_semi"), "inside")
    wanted = queries.select(F.col("x").alias("doc")).unionByName(targets.select(F.col("y").alias("doc"))).unionByName(inside.select("doc")).distinct()
    sets, sets_path = sets_of(docs, wanted, size)
    links, path = stash(links_inside_groups(thinned(inside, sets, percent), sets, percent).unionByName(links_between_groups(queries, targets, sets, percent)), "group-links")
    remove(spark, members_path, parts_path, queries_path, targets_path, inside_path, sets_path)
    return links, path


def join(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, percent: int = 90, leaders: int = LEADERS) -> DataFrame:
    """(key, n_shingles, component_id) of each row: documents link when 100 times the common n-grams are ``percent`` times all n-grams of both or more.

    A row without words has an empty set and links with nothing. Fewer words than ``size`` are one n-gram. A row with a null key links with nothing and has no component.
    Repeated rows have their row each and share a component; different texts under one key are one document to the links. An empty table
    stays empty. Other columns are dropped. Tokens are 64-bit hashes. ``leaders`` changes the work and not the result.
    """
    let_workers_import(df.sparkSession)
    spark = df.sparkSession
    docs = df.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    frequent = spark.sparkContext.broadcast(frequent_tokens(docs, size))
    rows, rows_path = stash(profiles(docs, size, percent, leaders, frequent), "profiles")
    named = rows.where("doc IS NOT NULL AND n > 0")
    first, first_path = stash(named.groupBy("h1", "h2", "n").agg(F.min("doc").alias("rep")), "sets")
    equal = named.join(first, ["h1", "h2", "n"]).where("doc != rep").select(F.col("doc").alias("a"), F.col("rep").alias("b"))
    reps = named.join(first.select(F.col("rep").alias("doc")), "doc", "left_semi").select("doc", "n", "mins").dropDuplicates(["doc"])
    pairs, leaders_path = leader_pairs(reps)
    near, near_path = stash(pairs.where(F.col("shared") >= F.lit(min(ALIKE, leaders))).select("a", "an", "b", "bn"), "near")
    led, led_path = stash(linked_by_text(near.where(may_be_as_large(F.col("an"), F.col("bn"), F.col("bn"), percent)).select("a", "b"), docs, size, percent), "led")
    linked = equal.unionByName(led)
    components, path = connected_components(linked, "components", with_path=True)
    groups, groups_path = connected_components(linked.unionByName(near.select("a", "b")), "groups", with_path=True)
    more, more_path = remaining_links(docs, named.groupBy("doc").agg(F.max("n").alias("n"), F.min("least").alias("least")), groups, components, size, percent, frequent)
    if not more.isEmpty():
        known, path_before = components, path
        components, path = connected_components(known.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more), "components", with_path=True)
        remove(spark, path_before)
    out = rows.select("doc", "n").join(components.select(F.col("node").alias("doc"), "component"), "doc", "left")
    out, _ = stash(out.select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id")), "ngram-join")
    remove(spark, rows_path, leaders_path, near_path, led_path, first_path, groups_path, more_path, path)
    return out
