import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from terrazone.llm import pitman_yor

END, START = object(), object()


def tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + [END]


def base_rows(rows):
    """{doc: (n_tokens, n_known, train_tokens, base_score)} by plain counting."""
    c = Counter(w for k, t in rows if zlib.crc32(str(k).encode()) % 7 != 2 or k is None for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return {k: (len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t))) for k, t in rows}


class Plain:
    """The same model with one restaurant after another and one customer after another, in dictionaries."""

    def __init__(self, texts, seed, sweeps=60, burn_in=20):
        self.draw = np.random.default_rng(seed)
        self.seats, self.all = defaultdict(lambda: defaultdict(list)), Counter(w for t in texts for w in tokens(t))
        events = [(u, w) for t in texts for u, w in zip([START] + tokens(t), tokens(t))]
        self.samples = []
        for u, w in events:
            self.sit(u, w)
        for sweep in range(sweeps):
            for u, w in events:
                self.leave(u, w)
                self.sit(u, w)
            if sweep >= burn_in:
                self.samples.append({u: {w: list(s) for w, s in d.items()} for u, d in self.seats.items()})

    @staticmethod
    def p(seats, u, w, known):
        discount, strength = pitman_yor.PARENT if u is None else pitman_yor.CONTEXT
        above = 1 / (known + 1) if u is None else Plain.p(seats, None, w, known)
        room = seats.get(u, {})
        c, t = sum(map(sum, room.values())), sum(map(len, room.values()))
        own = sum(room.get(w, [])) - discount * len(room.get(w, []))
        return (own + (strength + discount * t) * above) / (strength + c)

    def sit(self, u, w):
        discount, strength = pitman_yor.PARENT if u is None else pitman_yor.CONTEXT
        room, tables = self.seats[u], self.seats[u][w]
        above = 1 / (len(self.all) + 1) if u is None else self.p(self.seats, None, w, len(self.all))
        weights = [s - discount for s in tables] + [(strength + discount * sum(map(len, room.values()))) * above]
        k = self.draw.choice(len(weights), p=np.array(weights) / sum(weights))
        if k < len(tables):
            tables[k] += 1
        else:
            tables.append(1)
            if u is not None:
                self.sit(None, w)

    def leave(self, u, w):
        tables = self.seats[u][w]
        k = self.draw.choice(len(tables), p=np.array(tables) / sum(tables))
        tables[k] -= 1
        if not tables[k]:
            del tables[k]
            if u is not None:
                self.leave(None, w)

    def score(self, text):
        known = len(self.all)
        return sum(math.log10(np.mean([self.p(s, u, w, known) for s in self.samples])) for u, w in zip([START] + tokens(text), tokens(text)))


def texts_of(n, seed=0, words=12, length=15):
    draw = np.random.default_rng(seed)
    names = [f"w{i}" for i in range(words)]
    follow = draw.dirichlet(np.full(words, 0.2), words)
    out = []
    for _ in range(n):
        w, text = 0, []
        for _ in range(length):
            w = draw.choice(words, p=follow[w])
            text.append(names[w])
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("share, size", [(1 << 20, 1 << 21), (1 << 20, 60)])
def test_scores_are_those_of_a_plain_sampler(spark, documents, share, size):
    texts = texts_of(30) + ["w1 w2 never", "w3 seen w3", "Never w0 w0"]
    got = {r["doc_id"]: r for r in pitman_yor.evaluate(documents(texts), F.col("doc_id") < 25, share=share, size=size, burn_in=15, samples=10).collect()}
    plain = Plain(texts[:25], 1)
    for i, t in enumerate(texts):
        assert abs(got[i]["score"] - plain.score(t)) < 0.06 * len(tokens(t)), (i, got[i], plain.score(t))


def test_table_totals_are_those_of_a_plain_sampler():
    """A long chain over one block, and the parent's restaurant as it is added up."""
    texts, draw = texts_of(25), np.random.default_rng(0)
    samples = Plain(texts, 2, 120, 40).samples
    want = [np.mean([sum(len(t) for u, room in s.items() if (u is None) == parent for t in room.values()) for s in samples]) for parent in (False, True)]
    _, lengths, ids, h = next(pitman_yor.chunks(iter([pd.DataFrame({"text": texts})])))
    order, n = np.argsort(h), np.bincount(ids)
    words, n = h[order], n[order]
    counts = np.r_[np.where(words == pitman_yor.END, 0, n), len(texts)]
    m = pitman_yor.Model(words, counts, int(n.sum()), len(words), 1 << 20, 1, counts / 2, n / n.sum())
    pair, k = np.unique(ids * pitman_yor.WIDTH + pitman_yor.with_contexts(lengths, ids, h, m)[1], return_counts=True)
    block, parents, found = pitman_yor.first_block([[m.coded(h)[pair // pitman_yor.WIDTH], pair % pitman_yor.WIDTH, k]]), None, []
    for sweep in range(300):
        block, about = block.swept(m, draw, False, 8)
        contexts, tables, heads, customers, _ = pitman_yor.unpack(about)
        assert (heads == np.arange(len(words))).all()
        m.tables = np.zeros(len(words) + 1)
        m.tables[contexts] = tables
        parents = m.seat_parent(customers, parents, draw, 8)
        m.customers, m.shared = int(customers.sum()), int(parents.t.sum())
        m.head = m.parent(customers, parents.t)
        found.append((m.customers, m.shared))
    assert np.allclose(np.mean(found[100:], 0), want, rtol=0.06)


@pytest.mark.parametrize("share", [8, 1 << 20])
def test_probabilities_sum_to_one(spark, documents, share):
    docs = documents(texts_of(40, words=30))
    model, blocks, words = pitman_yor.fit(docs.select("text"), share=share, size=150)
    h = np.array([r["h"] for r in words.collect()], np.int64)
    parts = {r["block"]: pitman_yor.Predictions(pitman_yor.Block.unpack(bytes(r["data"])), model) for r in blocks.collect()}
    none = pitman_yor.Predictions(pitman_yor.first_block([]), model)
    unknown = np.int64(1 << 40)
    assert 1 < model.blocks and (len(model.words) < len(h)) == (share == 8)
    for context in range(model.rare + 1):
        total = 0.0
        for w in [*h, unknown]:
            w, c = model.coded(np.array([w])), np.array([context])
            total += parts.get(int(model.block(w, c)[0]), none).of(w, c)[0]
        if context in (model.start, model.rare) or model.counts[context]:
            assert abs(total - 1) < 1e-9


@pytest.mark.parametrize("share, size", [(1 << 20, 1 << 21), (40, 200)])
def test_counts_and_base_scores(spark, documents, share, size):
    rows = list(enumerate(texts_of(60, words=40) + [None, "", " \t\n ", "ÀB c ab AB", "x" * 50_000, "long " * 5000]))
    out = {r["doc_id"]: r for r in pitman_yor.evaluate(documents(rows, 5), pitman_yor.training(F.col("doc_id")), share=share, size=size).collect()}
    for k, (n, known, train, base) in base_rows(rows).items():
        r = out[k]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, train) and math.isclose(r["base_score"], base, rel_tol=1e-9), (k, r, base)
        assert r["score"] < 0


def test_the_chain_does_not_depend_on_partitions_and_beats_the_base(spark, documents):
    texts = texts_of(120, words=60, length=40)
    one, many = ({r["doc_id"]: r for r in pitman_yor.evaluate(documents(texts, p), pitman_yor.training(F.col("doc_id")), share=200, size=700).collect()} for p in (1, 9))
    assert all(math.isclose(one[k]["score"], many[k]["score"], rel_tol=1e-9) for k in one)
    held = [k for k in one if zlib.crc32(str(k).encode()) % 7 == 2]
    assert sum(one[k]["score"] for k in held) > 0.9 * sum(one[k]["base_score"] for k in held) and len(held) > 5


def test_seats_keep_their_customers():
    draw = np.random.default_rng(3)
    n = np.array([1, 2, 3, 50, 1000, 100_000])
    new = np.array([0.1, 2.0, 0.5, 3.0, 40.0, 0.01])
    seats = pitman_yor.Seats(*pitman_yor.Seats.opening(n, new, 0.7), draw)
    for _ in range(5):
        seats.move(new, 0.7)
        assert (seats.n == n).all() and (seats.t >= 1).all() and (seats.t <= n).all()
    grown = np.array([3, 1, 3, 500, 20, 99_000])
    seats.resize(grown, new, 0.7)
    t, sizes = seats.state()
    assert (np.add.reduceat(sizes, np.cumsum(t) - t) == grown).all() and (sizes > 0).all()


def test_tables_follow_their_distribution():
    """The number of tables of three customers, against all their seatings."""
    d, new, draw = 0.5, 0.8, np.random.default_rng(4)
    # weights of 1, 2 and 3 tables: products over the order of entering, each new table with weight ``new``
    weights = np.array([new * (1 - d) * (2 - d), new * new * 3 * (1 - d), new**3])
    many = np.full(4000, 3)
    seats = pitman_yor.Seats(*pitman_yor.Seats.opening(many, np.full(4000, new), d), draw)
    for _ in range(30):
        seats.move(np.full(4000, new), d, 3)
    assert np.abs(np.bincount(seats.t, minlength=4)[1:] / 4000 - weights / weights.sum()).max() < 0.03


def test_repeated_null_and_empty_rows(spark, documents):
    rows = [(1, "a b"), (1, "a b"), (1, "b"), (None, "a"), (None, None), (3, None), (3, "")]
    df = documents(rows).withColumn("n", F.lit(1)).withColumn("tag", F.lit("x")).withColumn("score", F.lit("x"))
    out = pitman_yor.evaluate(df, pitman_yor.training(F.col("doc_id")))
    assert out.columns == ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    found = sorted((r["doc_id"] or 0, r["n_tokens"]) for r in out.collect())
    assert found == [(0, 1), (0, 2), (1, 2), (1, 3), (1, 3), (3, 1), (3, 1)]
    assert pitman_yor.evaluate(documents([]), F.lit(True)).collect() == []
    unlearned = pitman_yor.evaluate(documents(["a b", None]), F.lit(False)).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in unlearned} == {(0, 0, 0.0, 0.0)}
    text = pitman_yor.evaluate(documents(["a", "b"]).withColumn("doc_id", F.concat(F.lit("k"), "doc_id")), F.lit(True)).collect()
    assert sorted(r["doc_id"] for r in text) == ["k0", "k1"]


def test_rare_contexts_have_restaurants(spark, documents):
    """Few words are frequent: the others' restaurants, which stand in several blocks, score as a plain sampler does, learned or not."""
    texts = texts_of(40, words=30, length=25)
    texts += ["w1 w2 w3 w4 w5", " ".join(f"w{i} w{i + 1}" for i in range(0, 28, 2)), "never w7 w8 never"]
    got = {r["doc_id"]: r["score"] for r in pitman_yor.evaluate(documents(texts), F.col("doc_id") < 36, share=10, size=150, burn_in=12, samples=10).collect()}
    whole = {r["doc_id"]: r["score"] for r in pitman_yor.evaluate(documents(texts), F.col("doc_id") < 36, burn_in=12, samples=10).collect()}
    assert all(abs(got[i] - whole[i]) < 0.06 * len(tokens(t)) for i, t in enumerate(texts))
    assert abs(sum(got.values()) - sum(whole.values())) < 0.01 * sum(len(tokens(t)) for t in texts)


def test_probabilities_after_rare_words_sum_to_one(spark, documents):
    docs = documents(texts_of(40, words=30))
    model, blocks, words = pitman_yor.fit(docs.select("text"), share=8, size=150)
    h = np.array([r["h"] for r in words.collect()], np.int64)
    parts = {r["block"]: pitman_yor.Predictions(pitman_yor.Block.unpack(bytes(r["data"])), model, r["replies"]) for r in blocks.collect()}
    none = pitman_yor.Predictions(pitman_yor.first_block([]), model)
    rare = [c for c in h if c not in model.words and c != pitman_yor.END]
    assert len(rare) > 5
    for context in rare:
        total, context = 0.0, np.array([context])
        home = parts[int(model.block(context, context)[0])]
        place = home.place(context)
        for w in [*h, np.int64(1 << 40)]:
            w = model.coded(np.array([w]))
            own = parts.get(int(model.block(w, context)[0]), none)
            seated = own.at_tables(w, np.array([0]), own.place(context))
            total += pitman_yor.averaged(seated, own.parents(w), home.customers[place], [t[place] for t in home.tables])[0]
        assert home.customers[place][0] > 0 and abs(total - 1) < 1e-9


def test_every_block_has_a_bucket_and_a_partition_of_its_own(spark):
    """Numbers counted from 0 on share some, so one task held the rows of several blocks."""
    for blocks in (1, 2, 28, 211):
        numbers = spark.createDataFrame([(int(n),) for n in pitman_yor.own_numbers(spark, blocks)], "block int")
        assert numbers.distinct().count() == blocks
        assert numbers.repartition(blocks, "block").select(F.spark_partition_id().alias("p")).distinct().count() == blocks
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * k) % 37}" for k in range(40))) for i in range(50)], "doc_id long, text string")
    model, blocks, _ = pitman_yor.fit(docs, size=100)
    assert model.blocks > 15 and [n for n in blocks.groupBy(F.spark_partition_id()).agg(F.countDistinct("block")).toPandas().iloc[:, 1] if n > 1] == []


def table_law(n, new, discount):
    """The probability of each number of tables of n customers, customer by customer."""
    ways = np.array([1.0])
    for k in range(n):
        t = np.arange(len(ways))
        ways = np.r_[ways * (k - discount * t), 0] + np.r_[0, ways] * new
        ways /= ways.sum()
    return ways


def test_a_sweep_seats_every_customer_again():
    """All sit alone at first, far from where their distribution is; no sweep leaves most of them there."""
    draw = np.random.default_rng(6)
    for n, new in ((9, 0.5), (40, 0.5), (300, 20.0)):
        law, new = table_law(n, new, 0.8), np.full(2000, new)
        seats = pitman_yor.Seats(np.full(2000, n), np.ones(2000 * n, np.int64), draw)
        seats.move(new, 0.8)
        assert abs(seats.t.mean() - (law * np.arange(n + 1)).sum()) < 0.15 * np.sqrt((law * np.arange(n + 1)).sum()) and (seats.n == n).all()
    many = pitman_yor.Seats(np.full(20, 3000), np.ones(60_000, np.int64), draw)
    many.move(np.full(20, 0.5), 0.8)
    assert (many.t < 1500).all() and (many.n == 3000).all() and (many.state()[1] > 0).all() and many.state()[1].sum() == 60_000


@pytest.mark.parametrize("new", [0.7, 12.0, 200.0])
def test_tables_of_large_dishes_follow_their_distribution(monkeypatch, new):
    """Customers that move one by one, in groups of tables, and large tables in pairs."""
    monkeypatch.setattr(pitman_yor, "WHOLE", 10)
    n, law, draw = np.full(1500, 60), table_law(60, new, 0.8), np.random.default_rng(7)
    want = (law * np.arange(61)).sum()
    spread = np.sqrt((law * (np.arange(61) - want) ** 2).sum())
    seats, found = pitman_yor.Seats.opened(n, np.full(1500, new), 0.8, draw), []
    for sweep in range(40):
        seats.move(np.full(1500, new), 0.8)
        found.append(seats.t)
    t, sizes = seats.state()
    assert (np.add.reduceat(sizes, np.cumsum(t) - t) == 60).all() and (sizes > 0).all()
    assert abs(np.mean(found[20:]) - want) < 0.06 * spread and abs(np.std(found[20:]) - spread) < 0.06 * spread


def test_large_dishes_grow_and_shrink():
    draw, new = np.random.default_rng(8), np.array([3.0, 0.5, 800.0, 40.0, 0.2, 1.0])
    sizes = [np.array([5000, 2000, 600, 1, 1, 9000]), np.array([20, 4000, 5000, 900, 1, 70_000]), np.array([2, 1100, 1030, 4000, 3, 5])]
    seats = pitman_yor.Seats.opened(sizes[0], new, 0.6, draw)
    for n in sizes:
        seats.resize(n, new, 0.6)
        for _ in range(2):
            t, each = seats.state()
            assert (np.add.reduceat(each, np.cumsum(t) - t) == n).all() and (each > 0).all() and (seats.n == n).all()
            seats.move(new, 0.6)
