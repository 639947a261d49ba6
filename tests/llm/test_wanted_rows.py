import pytest

from terrazone.llm import common


@pytest.mark.parametrize("marks", [64, common.MARKS])
def test_rows_with_and_without_wanted_keys(spark, monkeypatch, marks):
    """The same rows as by plain joins, null and repeated keys included, also where the bitmap rules out nothing."""
    monkeypatch.setattr(common, "MARKS", marks)
    df = spark.createDataFrame([(i % 400, f"t{i}") for i in range(600)] + [(None, "n"), (-5, "m")], "doc long, `a.b` string")
    keys = spark.createDataFrame([(i,) for i in range(0, 400, 3)] + [(0,), (-5,), (None,), (10**12,)], "doc long")
    inside = {(i % 400, f"t{i}") for i in range(600) if i % 400 % 3 == 0} | {(-5, "m")}
    rows = {tuple(r) for r in df.collect()}
    for got, want in ((common.having(df, "doc", keys), inside), (common.without(df, "doc", keys), rows - inside)):
        got = [tuple(r) for r in got.collect()]
        assert set(got) == want and len(got) == len(want)
    assert common.having(df, "doc", keys.limit(0)).count() == 0 and common.without(df, "doc", keys.limit(0)).count() == 602
