import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from terrazone.llm import boosting, personal_data as pd_

# the patterns as the contract words them
EMAIL, IP = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD, PHONE = r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"


def plain(text):
    digits = lambda s: [int(c) for c in s if c in "0123456789"]
    luhn = lambda d: sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(reversed(d))) % 10 == 0
    tests = [(EMAIL, lambda s: True), (IP, lambda s: all(int(p) <= 255 for p in s.split("."))), (CARD, lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))), (PHONE, lambda s: 9 <= len(digits(s)) <= 15)]
    return sorted((k, m.start(), m.end()) for k, (p, ok) in enumerate(tests) for m in re.finditer(p, text) if ok(m.group()))


@settings(max_examples=800, deadline=None)
@given(st.lists(st.sampled_from(["4111111111111111", "4111 1111-1111 1111", "1.2.3.4", "300.1.1.1", "+1 (523) 555-1055", "+49", "a.b@c.d", "@", "x@y", ".", "-", " ", "(", ")", "+", "0", "12", "255.", "é", "z@q.w-e.r", "\n", "%", "5500-0000 0000 0004", "00"]), max_size=14))
def test_strict_spans_are_those_of_the_patterns(parts):
    text = "".join(parts)
    assert pd_.propose(text)[0] == plain(text)


def test_long_texts_take_linear_time():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1 " * 60_000, "a@" * 100_000, "(" * 100_000, "1 2-" * 50_000, "a at " * 40_000 + "dot"):
        pd_.propose(text)


def test_cover():
    c = pd_.Cover()
    for a, b in ((10, 20), (30, 40), (18, 32), (50, 60)):
        c.add(a, b)
    assert (c.starts, c.ends) == ([10, 50], [40, 60])
    assert c.meets(39, 41) and not c.meets(40, 50) and c.meets(0, 11) and not c.meets(60, 70)


@pytest.fixture
def corpus(documents):
    rng = np.random.default_rng(1)
    def one(i):
        d = lambda n: "".join(map(str, rng.integers(0, 10, n)))
        kind = i % 6
        card = "4" + d(14)
        card += str(next(x for x in range(10) if pd_.luhn(card + str(x))))
        what = [f"user{d(2)}@mail{d(1)}.example.com", ".".join(map(str, rng.integers(0, 256, 4))), card, f"+1 ({d(3)}) 555-{d(4)}", f"version {d(1)}.{d(1)} of 20{d(2)}-1{d(1)}-2{d(1)} {d(4)} {d(4)} {d(4)} {d(3)}", "nothing"][kind]
        return f"some words before {what} and words after"
    return documents([one(i) for i in range(900)])


def test_trees_add_written_out_forms_and_leave_others(spark, corpus, documents):
    detector = pd_.fit(corpus)
    assert detector.trees is not None
    added = ["call me on (523) 555-1055 or so", "mail to user12 [at] mail5 [dot] example [dot] com today"]
    clean = ["no data in this text 12 of 400 on 2021-10-20", "chapter 1.2.3 page 45", "", None]
    rows = pd_.find_spans(documents(added + clean), detector).orderBy("doc_id").collect()
    assert [bool(r["spans"]) for r in rows] == [True, True, False, False, False, False]
    assert all(not s["base"] for r in rows for s in r["spans"])
    red = [r["text"] for r in pd_.redact(documents(["a@b.c and 1.2.3.4", None, "", "plain"]), detector).orderBy("doc_id").collect()]
    assert red == ["<EMAIL> and <IP>", None, "", "plain"]


def test_strict_spans_are_always_there(corpus):
    detector = pd_.fit(corpus, sample=50)
    for r in pd_.find_spans(corpus, detector).collect():
        assert [(pd_.KINDS.index(s["kind"]), s["start"], s["end"]) for s in r["spans"] if s["base"]] == plain(r["text"])
        assert [(pd_.KINDS.index(s["kind"]), s["start"]) for s in r["spans"]] == sorted((pd_.KINDS.index(s["kind"]), s["start"]) for s in r["spans"])


def test_without_examples_and_empty_table(documents, spark):
    docs = documents(["nothing here", None, ""]).withColumn("spans", F.lit(1))
    detector = pd_.fit(docs)
    assert detector.trees is None
    assert [r["spans"] for r in pd_.find_spans(docs, detector).collect()] == [[], [], []]
    assert pd_.find_spans(docs.limit(0), pd_.fit(docs.limit(0))).collect() == []


def test_kinds_of_few_documents_are_found(documents):
    rng = np.random.default_rng(4)
    d = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    texts = [f"note {i} on server {'.'.join(map(str, rng.integers(0, 256, 4)))} or {'.'.join(map(str, rng.integers(256, 900, 4)))}" for i in range(3000)]
    for i in range(0, 3000, 250):  # 12 documents of 3,000
        texts[i] = f"please write to some.user{d(2)}@mail{d(1)}.example.com about it"
    detector = pd_.fit(documents(texts), sample=160)
    assert detector.thresholds[0] <= 1
    found = pd_.find_spans(documents(["please write to user12 [at] mail5 [dot] example [dot] com about it"]), detector).first()["spans"]
    assert [s["kind"] for s in found] == ["email"]


def test_hashes_are_exact_where_tasks_have_no_candidate(documents):
    docs = documents(["write to a.b@c.example.com", "nothing", "at 1.2.3.4", "none"], 8).withColumn("h", F.xxhash64("text"))
    groups = pd_.documents_of_each_kind(docs.select("text", "h"), 80)
    have = {r["h"] for r in docs.collect()}
    assert [len(g) for g in groups[:2]] == [1, 1] and all(int(h) in have for g in groups for h in g)


def test_examples_of_dense_documents_and_without_labels():
    right, wrong = "(523) 555-1055", "1200 3400 5600 78001"
    rows = list(pd_.examples(" , ".join(["4111111111111111"] * 100 + [wrong] * 300 + [right] * 50), 1))
    natural = [y for x, y in rows if (x[0], x[1]) == (2, len(wrong))]
    assert len(natural) >= 300 and not any(natural)
    assert not [x for x, _ in pd_.examples(f"call {right} now", 1)]  # no label: neither data nor not
    assert [y for _, y in pd_.examples("on 2021-10-20 12 or 2021-10-20", 1)].count(0) >= 1


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    model = boosting.fit(x[:2000], y[:2000])
    assert ((model.score(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.93
    assert boosting.fit(np.zeros((4, 2)), np.array([0.0, 1, 1, 1])).score(np.zeros((1, 2)))[0] == pytest.approx(0.75, abs=0.1)
    assert len(model.score(np.zeros((0, 5)))) == 0
