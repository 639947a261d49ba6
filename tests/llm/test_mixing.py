import hashlib
import re

from terrazone.llm import mixing


def brute(rows, weights=(1.0, 2.0, 3.0), epochs=3):
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sources = sorted({r[2] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(size(r[1]) for r in rows if r[2] == s) for s in sources}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    target, capped = {}, set()
    while True:
        left = sum(total.values()) - sum(epochs * total[s] for s in capped)
        free = sum(weight[s] for s in sources if s not in capped)
        target = {s: epochs * total[s] if s in capped else left * weight[s] / free for s in sources}
        above = {s for s in sources if s not in capped and target[s] >= epochs * total[s]}
        if not above:
            break
        capped |= above
        if len(capped) == len(sources):
            target = {s: float(epochs * total[s]) for s in sources}
            break
    taken = {}
    for s in sources:
        rest = int(target[s] + 1e-6)
        whole, rest = divmod(rest, total[s]) if total[s] else (0, 0)
        for r in sorted((r for r in rows if r[2] == s), key=lambda r: md5(f"mix:{r[0] if r[0] is not None else '~'}:{md5(r[1] if r[1] is not None else '~')}")):
            part = min(size(r[1]), rest)
            rest -= part
            taken[r[0]] = (size(r[1]), total[s], target[s], whole * size(r[1]) + part)
    return taken


def test_targets_and_cuts(documents):
    rows = [(i, "word " * (i % 9), ["a", "b", "é", None, "\U0001F600", "z"][i % 6 if i % 2 else 0]) for i in range(300)] + [(900, None, "a"), (901, "", "only empty")]
    got = mixing.mix(documents(rows), slices=4).collect()
    want = brute(rows)
    for r in got:
        size, total, target, taken = want[r["doc_id"]]
        assert (r["size"], r["source_size"], r["taken"]) == (size, total, taken) and abs(r["target"] - target) < 1e-6
        assert r["taken"] <= 3 * r["size"] and r["copies"] in (r["taken"] // max(size, 1), r["taken"] // max(size, 1) + 1)


def test_reruns_agree_and_slices_change_nothing(documents):
    rows = [(i, "word " * (1 + i % 50), f"s{i % 3}") for i in range(400)]
    runs = [{(r["doc_id"], r["taken"]) for r in mixing.mix(documents(rows, p), slices=s).collect()} for p, s in ((1, 1), (5, 1024))]
    assert runs[0] == runs[1]


def test_one_source_and_small_sources(documents):
    one = mixing.mix(documents([(1, "a b c", "x"), (2, "d", "x")])).collect()
    assert all(r["taken"] == r["size"] and r["target"] == 4.0 and r["copies"] == 1 for r in one)
    rows = [(1, "a", "a"), (2, "b " * 100, "b"), (3, "c", "c")]
    assert {r["doc_id"]: r["taken"] for r in mixing.mix(documents(rows)).collect()} == {k: v[3] for k, v in brute(rows).items()}


def test_repeated_rows_null_ids_and_empty_table(documents, spark):
    rows = [(1, "a b c d e f", "x")] * 5 + [(None, "g h", "y"), (None, "g h", "y"), (2, "i j", "z")]
    got = mixing.mix(documents(rows)).collect()
    assert len(got) == 8
    for s in "xyz":
        own = [r for r in got if r["source"] == s]
        assert own[0]["target"] - len(own) <= sum(r["taken"] for r in own) <= own[0]["target"] + 1e-6
    assert mixing.mix(documents(rows).limit(0)).collect() == []
    assert set(mixing.mix(documents(rows).selectExpr("*", "1 AS size", "2 AS taken", "3 AS cut_key")).columns) >= {"cut_key", "size", "taken", "copies"}


def test_columns_that_begin_with_underscores_stay(documents):
    df = documents([(1, "a b c", "s"), (2, "d", "t")]).selectExpr("*", "'x' AS __mine", "7 AS __size", "1 AS ___key")
    out = mixing.mix(df).collect()
    assert {(r["__mine"], r["__size"], r["___key"]) for r in out} == {("x", 7, 1)} and {r["size"] for r in out} == {3, 1}
