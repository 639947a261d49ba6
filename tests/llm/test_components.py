import random

from terrazone.llm.components import connected_components


def smallest(links):
    parent = {}
    def top(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {x: top(x) for x in list(parent)}


def check(spark, links):
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert got == {k: v for k, v in smallest(links).items() if k != v}


def test_paths_stars_and_random_graphs(spark):
    rng = random.Random(2)
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 101 + i) for i in range(50)]
    reverse = [(300 - i, 299 - i) for i in range(30)]
    loose = [(rng.randint(1000, 1100), rng.randint(1000, 1100)) for _ in range(60)]
    check(spark, path + star + reverse + loose + [(7, 7), (0, 1), (1, 0)])


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
    check(spark, [(5, 5)])
