from pyspark.sql import functions as F

from terrazone.sources import sinks


def test_rows_are_written_as_they_come_and_none_is_lost(spark, tmp_path):
    """More combinations than files may be open; no step sorts all rows of a task."""
    df = spark.range(20_000).select("id", (F.col("id") % 10).alias("a"), (F.col("id") % 7).alias("b"))
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    path = str(tmp_path / "out")
    sinks.split_sink(df, path, ["a", "b"])
    assert spark.conf.get(name) == before
    store = spark._jsparkSession.sharedState().statusStore()
    plans = [store.executionsList().apply(i).physicalPlanDescription() for i in range(store.executionsCount())]
    written = next(p for p in reversed(plans) if path in p)
    assert "Sort" not in written
    back = spark.read.json(path)
    assert sorted(map(tuple, back.select("id", "a", "b").collect())) == sorted(map(tuple, df.collect()))
