"""Personal data: generators propose spans, boosted trees score them, calibrated thresholds select those to redact.

A span that satisfies the strict pattern of its kind is always kept. The generators also propose looser spans, which may
overlap: numbers in other groupings, telephone numbers without a plus, written-out e-mail addresses. A model of format and context
scores those; per kind, the lowest threshold that keeps the wanted precision on unseen rows selects what is added. The trees are fitted
on a bounded number of documents, as many as possible of each kind of span; thresholds come from all other documents.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from . import boosting

# fixed values: the kinds in their order, and the strict patterns (possessive where that changes no match)
KINDS = ("email", "ip", "card", "phone")
AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: All strict numeric spans lie inside such stretches.
NUMERIC = re.compile(r"[0-9+(][0-9+()\x20.-]{6,}")
# generators beyond the strict patterns
LOOSE_CARD = re.compile(r"(?<![0-9])[0-9]{3,6}(?:[\x20./-][0-9]{2,6}){2,5}(?![0-9])")
LOOSE_PHONE = re.compile(r"(?<![0-9+])(?:\([0-9]{2,4}\)\x20?|[0-9]{1,4}[\x20.-])(?:[0-9]{2,4}[\x20.-]?){1,4}[0-9]{2,4}(?![0-9])")
LOOSE_EMAIL = re.compile(r"[A-Za-z0-9._%+-]{1,64}\x20?[\[({\x20]at[\])}\x20]\x20?[A-Za-z0-9-]{1,64}(?:\x20?[\[({\x20]dot[\])}\x20]\x20?[A-Za-z0-9-]{1,64}|\.[A-Za-z0-9-]{1,64})+")
WORDS_BEFORE = re.compile(r"card|visa|credit|phone|tel|call|mobile|fax|mail|contact|write|server|host|addr", re.I)
SPANS = "array<struct<kind:string,start:int,end:int,score:double,base:boolean>>"
#: Documents from which the trees are fitted, examples of each kind and label among theirs, and the wanted precision of added spans.
SAMPLE, EXAMPLES, PRECISION = 4000, 20_000, 0.98
#: Steps of scores, of which thresholds are one.
STEPS = 1000
DATE = re.compile(r"(?:19|20)[0-9]{2}[\x20./-](?:0?[1-9]|1[0-2])[\x20./-][0-3]?[0-9](?![0-9])")


def luhn(digits: str) -> bool:
    doubled = [(2 * int(d) - 9 * (d > "4")) if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def strict_emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: from each @ back over the characters of a local part, not beyond the match before."""
    last = 0
    for m in AT_DOMAIN.finditer(text) if "@" in text else ():
        start = m.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            last = m.end()
            yield start, last


def strict_numbers(stretch: str) -> Iterator[tuple[int, int, int]]:
    for m in IP.finditer(stretch):
        if all(int(p[-4:]) <= 255 and not p[:-4].strip("0") for p in m.group().split(".")):
            yield 1, m.start(), m.end()
    for m in CARD.finditer(stretch):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield 2, m.start(), m.end()
    for m in PHONE.finditer(stretch):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            yield 3, m.start(), m.end()


def propose(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Strict spans and looser candidates as (kind, start, end); candidates of any kind may overlap."""
    base = [(0, a, b) for a, b in strict_emails(text)]
    loose = []
    for s in NUMERIC.finditer(text):
        at, stretch = s.start(), s.group()
        base += [(k, at + a, at + b) for k, a, b in strict_numbers(stretch)]
        loose += [(2, at + m.start(), at + m.end()) for r in (CARD, LOOSE_CARD) for m in r.finditer(stretch) if m.end() - m.start() >= 12]
        loose += [(3, at + m.start(), at + m.end()) for r in (PHONE, LOOSE_PHONE) for m in r.finditer(stretch)]
        loose += [(1, at + m.start(), at + m.end()) for m in IP.finditer(stretch)]
    if "at" in text and ("dot" in text or "at]" in text or "at)" in text or "at}" in text):
        loose += [(0, m.start(), m.end()) for m in LOOSE_EMAIL.finditer(text)]
    return sorted(set(base)), sorted(set(loose) - set(base))


def malformed(kind: int, span: str) -> bool:
    """Whether a looser candidate cannot be of its kind, by its format alone."""
    digits = re.sub("[^0-9]", "", span)
    if kind == 0:
        top = re.split(r"[^A-Za-z0-9-]+", span)[-1]
        return len(top) < 2 or not top.isalpha()
    if kind == 1:
        return any(int(p[-4:]) > 255 or p[:-4].strip("0") for p in span.split("."))
    if kind == 2:
        return not 13 <= len(digits) <= 19 or not luhn(digits)
    return not 9 <= len(digits) <= 15 or DATE.match(span) is not None


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format and context of a span."""
    span, before, after = text[start:end], text[max(0, start - 24):start], text[end:end + 2]
    digits = re.sub("[^0-9]", "", span)
    groups = [len(g) for g in re.findall("[0-9]+", span)] or [0]
    sort = lambda c: 0.0 if not c else 1.0 if c.isspace() else 2.0 if c.isalpha() else 3.0 if c.isdigit() else 4.0
    return [kind, len(span), len(digits), len(groups), max(groups), min(groups), groups[-1], groups[0], span.count(" "), span.count("."), span.count("-"), span.count("/"),
            span.count("("), span.startswith("+"), "@" in span, luhn(digits) if digits else 0, max(int(g[-4:]) for g in re.findall("[0-9]+", span)) if digits else 0,
            len(set(digits)), sum(map(str.isalpha, span)) / len(span), bool(re.search(r"\bat\b", span)), span.count("dot"), sort(before[-1:]), sort(after[:1]),
            sort(after[1:]), bool(WORDS_BEFORE.search(before)), sum(c.isdigit() for c in before), span[-1:].isalpha()]


def variants(text: str, kind: int, start: int, end: int, rng: random.Random) -> Iterator[tuple[str, int, int, int, int]]:
    """The same data written otherwise (label 1) and spoiled (label 0), in the same context."""
    span = text[start:end]
    digits = re.sub("[^0-9]", "", span)
    put = lambda new, y: (text[max(0, start - 40):start] + new + text[end:end + 40], kind, min(start, 40), min(start, 40) + len(new), y)
    if kind == 0:
        left, _, domain = span.partition("@")
        host, _, top = domain.rpartition(".")
        yield put(f"{left} [at] {host.replace('.', ' [dot] ')} [dot] {top}", 1)
        yield put(f"{left} at {host.replace('.', ' dot ')} dot {top}", 1)
        yield put(f"{left[:3]} at {host[:4]}.{rng.choice('0123456789')}", 0)
    elif kind == 1:
        yield put(".".join(str(rng.randint(256, 999)) for _ in range(4)), 0)
    elif kind == 2:
        good = ".".join(digits[i:i + 4] for i in range(0, len(digits), 4))
        yield put(good, 1)
        spoiled = digits[:-1] + str((int(digits[-1]) + rng.randint(1, 9)) % 10)
        yield put(spoiled, 0)
        yield put(".".join(spoiled[i:i + 4] for i in range(0, len(digits), 4)), 0)
    else:
        number = digits[-10:]
        yield put(f"({number[:3]}) {number[3:6]}-{number[6:]}", 1)
        yield put(f"{number[:3]}-{number[3:6]}-{number[6:]}", 1)
        yield put(f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)} {rng.randint(10, 23)}", 0)
        yield put(f"{rng.randint(1900, 2030)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}", 0)
        yield put(f"{rng.randint(1, 99)} {rng.randint(100, 999)} {rng.randint(100, 999)}", 0)


class Cover:
    """Disjoint stretches of a text in order; spans that overlap or touch are joined."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def meets(self, start: int, end: int) -> bool:
        i = bisect_right(self.ends, start)
        return i < len(self.starts) and self.starts[i] < end

    def add(self, start: int, end: int) -> None:
        i, j = bisect_left(self.ends, start), bisect_right(self.starts, end)
        if i < j:
            start, end = min(start, self.starts[i]), max(end, self.ends[j - 1])
        self.starts[i:j], self.ends[i:j] = [start], [end]


def examples(text: str, seed: int) -> Iterator[tuple[list[float], int]]:
    """Labelled rows of a text: strict spans, their variants, and as negatives the other candidates of a wrong format; those of a right one have no label."""
    rng, (base, loose) = random.Random(seed), propose(text)
    for k, a, b in base:
        yield features(text, k, a, b), 1
        for other, kind, s, e, y in variants(text, k, a, b, rng):
            yield features(other, kind, s, e), y
    known = Cover()
    for _, a, b in base:
        known.add(a, b)
    for k, a, b in loose:
        if malformed(k, text[a:b]) and not known.meets(a, b):
            yield features(text, k, a, b), 0


@dataclass
class Detector:
    trees: boosting.Boosted | None
    thresholds: tuple[float, ...]

    def find(self, text: str) -> list[tuple[int, int, int, float, bool]]:
        """(kind, start, end, score, strict) by kind and start. Added spans overlap neither strict nor better ones."""
        base, loose = propose(text)
        chosen = [(*s, 1.0, True) for s in base]
        taken = Cover()
        for _, a, b in base:
            taken.add(a, b)
        loose = [c for c in loose if not taken.meets(c[1], c[2])]
        if loose and self.trees is not None:
            scores = self.trees.score(np.array([features(text, *c) for c in loose], float))
            for score, (k, a, b) in sorted(zip(scores.tolist(), loose), key=lambda x: (-x[0], x[1])):
                if score >= self.thresholds[k] and not taken.meets(a, b):
                    taken.add(a, b)
                    chosen.append((k, a, b, score, False))
        return sorted(chosen)


def documents_of_each_kind(rows: DataFrame, sample: int) -> list[np.ndarray]:
    """Hashes of documents with a strict span of each kind, then with a looser candidate of each kind: the smallest of each, ``sample`` in all.

    All documents are looked through; each task passes on the smallest hashes of its own.
    """
    groups = 2 * len(KINDS)
    most = max(3, sample // groups)

    def smallest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[set[int]] = [set() for _ in range(groups)]
        for batch in batches:
            for t, h in zip(batch["text"], batch["h"]):
                base, loose = propose(t)
                for g in {k for k, *_ in base} | {len(KINDS) + k for k, *_ in loose}:
                    held[g].add(h)
            held = [set(sorted(x)[:most]) for x in held]
        yield pd.DataFrame({"g": range(groups), "h": [sorted(x) for x in held]})

    found = rows.mapInPandas(smallest, "g int, h array<long>").toPandas()
    # an empty list may come as floats, which cannot hold hashes
    return [np.unique(np.concatenate([np.zeros(0, np.int64), *(np.asarray(h, np.int64) for h in found["h"][found["g"] == g])]))[:most] for g in range(groups)]


def drawn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of the examples of all documents of a task at most EXAMPLES of each kind and label, those of the smallest uniform draw."""
    held: dict[tuple[int, int], list] = {}
    for batch in batches:
        for t, h in zip(batch["text"], batch["h"]):
            draw = random.Random(h)
            for x, y in examples(t, h):
                held.setdefault((int(x[0]), y), []).append((draw.random(), h, [float(v) for v in x]))
            for group in held.values():
                if len(group) > 2 * EXAMPLES:
                    group[:] = sorted(group)[:EXAMPLES]
    for (kind, y), group in sorted(held.items()):
        group = sorted(group)[:EXAMPLES]
        yield pd.DataFrame({"draw": [d for d, *_ in group], "h": [h for _, h, _ in group], "x": [x for *_, x in group], "kind": kind, "y": y})


def score_counts(rows: DataFrame, trees: boosting.Boosted, fitted: frozenset[int]) -> np.ndarray:
    """Examples of all documents, counted by (document among the fitted ones, kind, label, step of the score)."""
    shape = (2, len(KINDS), 2, STEPS + 1)
    shared = rows.sparkSession.sparkContext.broadcast((trees, fitted))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, seen = shared.value
        total, cells, x = np.zeros(np.prod(shape), np.int64), [], []

        def add():
            if x:
                steps = np.floor(model.score(np.array(x, float)) * STEPS).astype(np.int64)
                np.add.at(total, np.ravel_multi_index((*np.array(cells).T, steps), shape), 1)
            cells.clear(), x.clear()

        for batch in batches:
            for t, h in zip(batch["text"], batch["h"]):
                for row, y in examples(t, h):
                    cells.append((h in seen, int(row[0]), y))
                    x.append(row)
                if len(x) > 5000:
                    add()
        add()
        there = np.flatnonzero(total)
        yield pd.DataFrame({"cell": there, "n": total[there]})

    table = rows.mapInPandas(counted, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(np.prod(shape), np.int64)
    out[table["cell"].to_numpy(np.int64)] = table["n"].to_numpy(np.int64)
    return out.reshape(shape)


def fit(df: DataFrame, text: str = "text", key: list[str] = ("doc_id",), sample: int = SAMPLE, precision: float = PRECISION) -> Detector:
    """Fit on about ``sample`` documents, an equal number for each kind of strict span and looser candidate, or all where there are fewer.

    Every third of these is not fitted on. Thresholds come from the scores in all documents that were not; for a kind with examples of label
    1 in fitted documents only, from those. Only feature rows, hashes and counts come to the driver. Equal texts are one document to the fit, and
    count as often as they stand there for the thresholds. Where no document has a strict span, or none a negative, nothing is added to the strict spans.
    """
    rows = df.where(F.col(text).isNotNull()).select(F.col(text).cast("string").alias("text"), F.xxhash64(text).alias("h"))
    groups = documents_of_each_kind(rows, sample)
    held = {int(h) for g in groups for h in g[1::3]}
    fitted = frozenset(int(h) for g in groups for h in g) - held
    names = df.sparkSession.createDataFrame([(h,) for h in sorted(fitted)], "h long")
    chosen = rows.join(F.broadcast(names), "h").groupBy("h").agg(F.min("text").alias("text"))
    table = chosen.mapInPandas(drawn, "draw double, h long, x array<double>, kind int, y int").toPandas()
    table = table.assign(order=table["x"].map(tuple)).sort_values(["draw", "h", "order"]).groupby(["kind", "y"]).head(EXAMPLES)
    if table["y"].nunique() < 2:
        return Detector(None, (1.0,) * 4)
    trees = boosting.fit(np.array(table["x"].tolist()), table["y"].to_numpy(float))
    thresholds = []
    for unseen, seen in zip(*score_counts(rows, trees, fitted)):
        clean, right = np.cumsum((unseen if unseen[1].any() else seen)[:, ::-1], 1)  # from the highest step down
        good = np.flatnonzero((right > 0) & (right >= precision * (right + clean)) & (np.arange(STEPS, -1, -1) >= STEPS // 2))
        thresholds.append((STEPS - int(good[-1])) / STEPS if len(good) else 1.1)
    return Detector(trees, tuple(thresholds))


def find_spans(df: DataFrame, detector: Detector, text: str = "text", name: str = "spans") -> DataFrame:
    """Add the personal data of each whole text as an array of (kind, start, end, score, base), by kind and start; code points, end exclusive.

    A null or empty text has none. Rows are independent: repeated rows get equal spans, an empty table stays empty, other columns pass
    through, a column already called ``name`` is replaced. One pass without a shuffle.
    """
    model = df.sparkSession.sparkContext.broadcast(detector)

    @F.pandas_udf(SPANS)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[{"kind": KINDS[k], "start": a, "end": b, "score": p, "base": s} for k, a, b, p, s in model.value.find(t)] if t else [] for t in texts], dtype=object)

    return df.withColumn(name, found(F.col(text)))


def redact(df: DataFrame, detector: Detector, text: str = "text") -> DataFrame:
    """Replace each span by its kind in angle brackets; of overlapping spans the union is replaced under the first one's kind. Null stays null."""
    model = df.sparkSession.sparkContext.broadcast(detector)

    def clean(t: str | None) -> str | None:
        spans = sorted(model.value.find(t), key=lambda s: s[1]) if t else []
        out, at = [], 0
        for k, a, b, *_ in spans:
            if a >= at:
                out += [t[at:a], f"<{KINDS[k].upper()}>"]
            at = max(at, b)
        return "".join([*out, t[at:]]) if spans else t

    @F.pandas_udf("string")
    def cleaned(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(clean, na_action="ignore")

    return df.withColumn(text, cleaned(F.col(text)))
