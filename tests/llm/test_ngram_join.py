import random
import re
from collections import Counter, defaultdict

import pytest

from terrazone.llm import ngram_join as nj


def brute(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets[i] = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    where, parent = defaultdict(list), {i: i for i in sets}
    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, s in sets.items():
        common = Counter(j for x in s for j in where[x])
        for j, k in common.items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
        for x in s:
            where[x].append(i)
    return {i: (len(s), top(i)) for i, s in sets.items()}


def made(seed=3, groups=40):
    rng = random.Random(seed)
    words, rows = [f"W{i}" for i in range(3000)], []
    for _ in range(groups):
        n = rng.choice([1, 2, 3, 5, 9, 12, 15, 25, 40, 80, 200, 500])
        base = [rng.choice(words) for _ in range(n)]
        for _ in range(rng.choice([1, 2, 3, 8, 30])):
            w = list(base)
            for _ in range(rng.randint(0, max(1, int(n * rng.choice([0, 0.01, 0.03, 0.05]))))):
                k, op = rng.randrange(len(w)), rng.random()
                if op < 0.4:
                    w[k] = rng.choice(words)
                elif op < 0.7:
                    w.insert(k, rng.choice(words))
                elif len(w) > 1:
                    del w[k]
            rows.append(" ".join(w))
    rows += [None, "", "  \n", "A b", "a  B", "É x y", "é x y"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("size,percent,leaders,block,often,paired", [(3, 90, 6, 512, 3, 16), (3, 90, 0, 512, 1, 2), (5, 80, 1, 4, 3, 1), (1, 80, 0, 512, 10**9, 16), (2, 60, 1, 7, 2, 3), (3, 80, 6, 3, 1, 1)])
def test_all_pairs(documents, size, percent, leaders, block, often, paired, monkeypatch):
    """Without leaders all links are found through parts and the matrix; small blocks, few pairs of a part and any list of frequent tokens change nothing."""
    monkeypatch.setattr(nj, "PAIRED", paired)
    monkeypatch.setattr(nj, "BLOCK", block)
    monkeypatch.setattr(nj, "OFTEN", often)
    rows = made()
    got = nj.join(documents(rows), size=size, percent=percent, leaders=leaders).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(rows, size, percent)


def test_groups_of_several_members_meet_through_the_matrix(documents):
    """A chain of documents, each a little further: neighbours link, ends do not, all are one component."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[4 * i:200 + 4 * i])) for i in range(30)]
    for leaders in (0, 1, 6):
        got = nj.join(documents(rows), leaders=leaders).collect()
        assert {r["component_id"] for r in got} == {0}


@pytest.mark.parametrize("often", [3, 10**9])
def test_templated_documents_that_do_not_link(documents, often, monkeypatch):
    """2,000 documents of 150 common words and 40 of their own, and copies of some: only the copies link, and nothing is compared that the matrix rules out."""
    monkeypatch.setattr(nj, "OFTEN", often)
    compared = []
    monkeypatch.setattr(nj, "links_inside_groups", lambda rows, *a, f=nj.links_inside_groups: (compared.append(rows.count()), f(rows, *a))[1])
    common = " ".join(f"c{i}" for i in range(150))
    rows = [(i, common + " " + " ".join(f"o{i}_{k}" for k in range(40))) for i in range(2000)]
    rows += [(5000 + i, rows[i][1] + " more") for i in range(20)]
    got = {r["doc_id"]: r["component_id"] for r in nj.join(documents(rows, 8), size=3, percent=90).collect()}
    assert got == {**{i: i for i in range(2000)}, **{5000 + i: i for i in range(20)}}
    assert compared[0] < 1000


def test_one_part_of_very_many_groups_forms_few_pairs(spark, documents, monkeypatch):
    """Near copies of one text, too far from each other to link: a bounded number of pairs of groups, and all links as by brute force."""
    rng = random.Random(8)
    base, met = [f"b{i}" for i in range(120)], []
    monkeypatch.setattr(nj, "group_meetings", lambda *a, f=nj.group_meetings: (lambda out: (met.append((out[0].count(), out[1].count())), out)[1])(f(*a)))
    rows = []
    for i in range(700):
        w = list(base)
        for k in rng.sample(range(120), 6):
            w[k] = f"e{i}_{k}" if i % 50 else f"same{k % 2}"
        rows.append((i, " ".join(w)))
    got = nj.join(documents(rows, 8), size=3, percent=80, leaders=0).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(rows, 3, 80)
    assert met[0][0] < 16 * 700 and met[0][1] > 0


def test_rows(spark):
    long = "alpha beta gamma " * 20_000
    data = [(1, "a b c d", "x"), (1, "a b c d", "y"), (2, "a b c d", "x"), (None, "a b c d", "x"), (3, None, "x"), (4, long, "x"), (5, long, "x"), (None, None, "x")]
    df = spark.createDataFrame(data, "doc_id long, text string, component_id string")
    got = sorted([tuple(r) for r in nj.join(df).select("doc_id", "n_shingles", "component_id").collect()], key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (2, 2, 1), (None, 2, None), (3, 0, 3), (4, 3, 4), (5, 3, 4), (None, 0, None)], key=str)
    assert nj.join(df.limit(0)).collect() == []


def test_linked_sets_agree_on_a_listed_part():
    import numpy as np
    rng = np.random.default_rng(1)
    for percent in (60, 80, 90):
        shapes = nj.Shapes(percent)
        for _ in range(300):
            n = int(rng.integers(1, 400))
            x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            drop = int(rng.integers(0, n // 4 + 1))
            y = np.unique(np.concatenate([x[drop:], rng.integers(0, 2**63, int(rng.integers(0, n // 4 + 1))).astype(np.uint64)]))
            common = len(np.intersect1d(x, y))
            if len(x) != common and 100 * common >= percent * (len(x) + len(y) - common):
                for frequent in (x[:0], x[::2], np.sort(x), np.union1d(x, y)[5:]):
                    (a, least_a), (b, least_b) = shapes.signatures(x, frequent), shapes.signatures(y, frequent)
                    assert len(set(a) & set(b)) >= max(least_a, least_b)


def test_tokens_of_a_large_group_make_no_row_each(spark, monkeypatch):
    """Groups beyond a block are thinned as the matrix says, from packed rows: pieces times slices of them, not one a token."""
    import numpy as np
    monkeypatch.setattr(nj, "BLOCK", 20)
    rng = np.random.default_rng(5)
    common = rng.integers(-2**62, 2**62, 60)
    sets = {i: np.unique(np.r_[common[:40 + i % 20], rng.integers(-2**62, 2**62, 2 if i % 3 else 60)]) for i in range(200)} | {500: common[:50], 501: common[:51]}
    groups = {i: (0 if i < 150 or i >= 500 else 1 + i // 195, i // 2 if i < 60 else i) for i in sets}
    inside = spark.createDataFrame([(groups[i][0], i, len(t), groups[i][1]) for i, t in sets.items()], "g long, doc long, n long, c long").repartition(5)
    table = spark.createDataFrame([(i, t.tolist()) for i, t in sets.items()], "doc long, tokens array<long>").repartition(4)

    def brute(rows):
        seen = defaultdict(set)
        for i in rows:
            for t in sets[i].tolist():
                seen[groups[i][0], t].add(groups[i][1])
        large = Counter(groups[i][0] for i in all_rows)
        overlap = {i: sum(len(seen[groups[i][0], t]) > 1 for t in sets[i].tolist()) for i in rows}
        return [i for i in rows if large[groups[i][0]] <= 20 or overlap[i] * 190 >= 90 * (len(sets[i]) - (-len(sets[i]) * 90 // 100))]

    all_rows = list(sets)
    got = sorted(r["doc"] for r in nj.thinned(inside, table, 90).collect())
    assert got == sorted(brute(brute(all_rows))) and 20 < len(got) < 200
    own = inside.where("g = 0").selectExpr("*", "8 AS pieces", "CAST(pmod(doc, 8) AS INT) AS piece").join(table, "doc")
    assert nj.shared_tokens(own).count() <= 8 * 8
