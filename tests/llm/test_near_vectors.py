import math

import numpy as np
import pytest

from terrazone.llm import near_vectors as nv

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"


def brute(rows, threshold):
    """links and smallest reachable id of each row, from all pairs."""
    ok = [v is not None and len(v) > 0 and None not in v and all(map(math.isfinite, v)) and any(v) and l is not None and i is not None for i, v, l, _ in rows]
    unit = [np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) if k else None for (_, v, _, _), k in zip(rows, ok)]
    n = len(rows)
    linked = [[j for j in range(n) if i != j and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            new = [j for j in linked[todo.pop()] if j not in seen]
            seen.update(new)
            todo += new
        ids = [rows[j][0] for j in seen]
        out.append((rows[i][0], len(linked[i]), min(ids) if None not in ids else rows[i][0]))
    return sorted(out, key=str)


def made(count=260, dimension=16):
    rng = np.random.default_rng(4)
    rows, i = [], 0
    for group in range(40):
        base, label = rng.standard_normal(dimension), int(rng.integers(0, 3))
        for _ in range(int(rng.choice([1, 1, 2, 5, 20]))):
            noise = rng.standard_normal(dimension) * rng.choice([0.0, 0.05, 0.2])
            rows.append((i, [float(x) for x in (base + noise).astype(np.float32)], label, "x"))
            i += 1
    return rows


@pytest.mark.parametrize("block", [1024, 8])
def test_all_pairs(spark, block, monkeypatch):
    monkeypatch.setattr(nv, "BLOCK", block)
    rows = made() + [(1000, None, 1, "x"), (1001, [0.0] * 16, 1, "x"), (1002, [float("nan")] * 16, 1, "x"), (1003, [1.0] * 15 + [None], 1, "x"), (1004, [1.0] * 16, None, "x"), (1005, [1.0] * 16, None, "x"),
                     (1006, [], 1, "x"), (None, [1.0] * 16, 1, "x"), (1007, [1.0] * 16, 1, "x"), (1008, [2.0] * 16, 1, "x"), (1009, [1.0] * 8, 1, "x"), (1010, [1e-30] * 8, 1, "x"), (1011, [float("inf")] * 8, 1, "x")]
    got = nv.link(spark.createDataFrame(rows, SCHEMA).repartition(5), threshold=0.93).collect()
    assert sorted([(r["vec_id"], r["n_links"], r["component_id"]) for r in got], key=str) == brute(rows, 0.93)
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in got)


def test_repeated_rows_and_empty_table(spark):
    row = (3, [1.0, 2.0], 0, "x")
    got = nv.link(spark.createDataFrame([row, row, (4, [1.0, 2.0], 0, "x"), (5, [-1.0, 2.0], 0, "x")], SCHEMA)).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got) == [(3, 2, 3, True), (3, 2, 3, True), (4, 2, 3, False), (5, 0, 5, True)]
    assert nv.link(spark.createDataFrame([], SCHEMA)).collect() == []


def test_estimates_are_unbiased_and_bounds_hold():
    rng = np.random.default_rng(1)
    a, b = rng.standard_normal((2, 64))
    a, b = a / np.linalg.norm(a), b / np.linalg.norm(b)
    b = 0.6 * a + 0.8 * (b - (a @ b) * a) / np.linalg.norm(b - (a @ b) * a)
    estimates = []
    for seed in range(300):
        book = nv.Codes(64, 0.93, 1000, seed)
        _, codes, f = book.coded(np.stack([a, b]))
        x, y = (2.0 * np.unpackbits(codes[:, k], axis=1) - 1 for k in (0, 1))
        e = (x @ book.between @ y.T) / 64 / (f[:, :1] * f[:, 1])
        estimates.append((e[0, 1] + e[1, 0]) / 2)
    assert abs(np.mean(estimates) - 0.6) < 4 * np.std(estimates) / math.sqrt(300)
    c = 0.94 * a + math.sqrt(1 - 0.94**2) * (b - 0.6 * a) / 0.8
    kept = [nv.Codes(64, 0.93, 1000, s).may_link(*nv.Codes(64, 0.93, 1000, s).coded(np.stack([a, c]))[1:])[0, 1] for s in range(200)]
    assert np.mean(kept) > 0.99


def test_recall_of_bands_at_the_threshold():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.standard_normal((2000, 64))
    y -= (x * y).sum(1, keepdims=True) * x
    y = 0.931 * x + math.sqrt(1 - 0.931**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    for rows in (1000, 1_000_000, 10**9):
        book = nv.Codes(64, 0.93, rows)
        shared = (book.parts(book.signs(x)) == book.parts(book.signs(y))).any(1)
        assert shared.mean() > 0.995
