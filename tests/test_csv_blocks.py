"""One multi-line CSV file read in many blocks."""

import csv

from pyspark.sql import types as T

from terrazone.sources import readers as rd

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "text", "note")])


def test_multi_line_cells_across_blocks(spark, tmp_path):
    rows = [(str(i), [f"plain {i}", f'line one\nline "two" of {i}\n\nlast', "a,b;c", "", 'say ""', "x\n" * (i % 50), f"é {i} €"][i % 7], "end" if i % 3 else "two\nlines") for i in range(3000)]
    path = tmp_path / "one.csv"
    with open(path, "w", newline="", encoding="utf-8") as f:
        writer = csv.writer(f, lineterminator="\n")
        writer.writerow(SCHEMA.names)
        writer.writerows(rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 8192)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 10
        got = sorted((r["id"], r["text"] or "", r["note"]) for r in rd.scan_csv_blocks(spark, str(path), SCHEMA).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert got == sorted(rows)
    assert got == sorted((r["id"], r["text"] or "", r["note"]) for r in rd.scan_csv_evidence(spark, str(path), SCHEMA).collect())
