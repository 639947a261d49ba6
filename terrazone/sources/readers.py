"""Readers: every reader declares its schema, and non-finite numbers become NULL on the way in."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.scalars import col, finite

POSITION = T.ArrayType(T.DoubleType())
FEATURES = T.StructType([
    T.StructField("crs", T.StructType([T.StructField("properties", T.StructType([T.StructField("name", T.StringType())]))])),
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("geometry", T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())]))]))),
])
POLYGON = T.ArrayType(T.ArrayType(POSITION))
MULTIPOLYGON = T.ArrayType(POLYGON)


def scan_csv_evidence(spark: SparkSession, path, schema: T.StructType | None = None) -> DataFrame:
    """CSV with header, byte-order mark, doubled quotes and very large multi-line cells; all columns are text.

    A file is one task here: ``scan_csv_blocks`` reads one huge file by many.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("maxCharsPerColumn", -1).option("encoding", "UTF-8")
    return (reader.schema(schema) if schema else reader).csv(path)


def scan_csv_blocks(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """The same rows as ``scan_csv_evidence`` with a schema, from files of any size that many tasks read.

    A file is read by lines, block by block. A line break belongs to a cell if an odd number of quotes stands before it in the file; that number is a
    running sum over blocks (one row each) plus one over the lines of a block. So records are numbered without reading a file in one piece, the lines of
    a record are put together, wherever it crosses blocks, and each record is parsed alone. A file's first record is its header.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"), "value")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = lines.withColumn("_q", quotes.cast("long"))
    blocks = lines.groupBy("_file", "_block").agg(F.sum("_q").alias("_sum"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_file", "_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_file", "_block").orderBy("_at")
    placed = lines.join(blocks, ["_file", "_block"]).withColumn("_opens", (F.col("_before") + F.sum("_q").over(inside) - F.col("_q")) % 2 == 0)
    placed = placed.withColumn("_in_block", F.sum(F.col("_opens").cast("long")).over(inside))
    starts = placed.groupBy("_file", "_block").agg(F.sum(F.col("_opens").cast("long")).alias("_n"))
    starts = starts.select("_file", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    numbered = placed.join(starts, ["_file", "_block"]).withColumn("_record", F.col("_offset") + F.col("_in_block"))
    texts = numbered.groupBy("_file", "_record").agg(F.array_sort(F.collect_list(F.struct("_block", "_at", "value"))).alias("_lines"))
    whole = F.array_join(F.transform("_lines", lambda x: x["value"]), "\n")
    body = texts.where("_record > 1").select(F.regexp_replace(whole, "\r$", "").alias("_text")).where("_text <> ''")
    options = {"quote": '"', "escape": '"', "maxCharsPerColumn": "-1", "mode": "PERMISSIVE"}
    return body.select(F.from_csv("_text", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options).alias("_row")).select("_row.*")


def scan_json_records(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """A list of JSON records per file, or one record per line."""
    return spark.read.option("multiLine", True).schema(schema).json(path)


def scan_json_lines(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def typed_decode(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Decode text columns: '' is NULL, 'True'/'False' booleans, JSON text its declared type, else trimmed text.

    ``kinds`` maps a column to ``text``, ``boolean``, a numeric type, or a DDL type to parse as JSON.
    """
    def decode(name: str, kind: str) -> Column:
        s = F.nullif(F.col(name), F.lit(""))
        if kind == "text":
            return F.trim(s)
        if kind == "boolean":
            return F.when(s == "True", True).when(s == "False", False)
        if kind in ("int", "bigint", "double"):
            v = F.trim(s).try_cast(kind)
            return finite(v) if kind == "double" else v
        return F.from_json(s, kind)
    return df.withColumns({n: decode(n, k) for n, k in kinds.items()})


def decoded_kind(text) -> Column:
    """What ``typed_decode`` would make of a text: null, boolean, json or text (booleans are tested first)."""
    s = col(text)
    return (F.when(s.isNull() | (s == ""), "null").when(s.isin("True", "False"), "boolean")
            .when(F.try_parse_json(s).isNotNull(), "json").otherwise("text"))


def zone_vertices(documents: DataFrame, id_property: str, default_crs: str | None = None) -> DataFrame:
    """Feature documents (schema ``FEATURES``) to vertex rows: zone_id, part, ring, seq, x, y, status.

    Missing reference systems, empty or non-polygon geometry and unclosed rings are flagged; the repeated
    closing position is dropped. Crossing rings are found with ``operators.geometry.geo_is_simple``.
    """
    f = documents.select(F.coalesce(F.col("crs.properties.name"), F.lit(default_crs)).alias("crs"), F.explode_outer("features").alias("f"))
    kind, text = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    parts = F.when(kind == "Polygon", F.array(F.from_json(text, POLYGON))).when(kind == "MultiPolygon", F.from_json(text, MULTIPOLYGON))
    status = (F.when(F.col("f").isNull(), "EMPTY").when(F.col("crs").isNull(), "MISSING_CRS").when(~F.coalesce(kind.isin("Polygon", "MultiPolygon"), F.lit(False)), "NOT_A_POLYGON")
              .when(F.coalesce(F.size(parts), F.lit(0)) == 0, "EMPTY").otherwise("OK"))
    z = f.select(F.col("f.properties")[id_property].alias("zone_id"), "crs", parts.alias("parts"), status.alias("status"))
    v = z.select("zone_id", "crs", "status", F.posexplode_outer("parts").alias("part", "rings")).select("*", F.posexplode_outer("rings").alias("ring", "positions"))
    n = F.size("positions")
    closed = F.element_at("positions", 1) == F.element_at("positions", -1)
    v = v.withColumns({"status": F.when((F.col("status") == "OK") & ~F.coalesce(closed & (n >= 4), F.lit(False)), "UNCLOSED_RING").otherwise(F.col("status")),
                       "positions": F.when(closed, F.slice("positions", 1, F.greatest(n - 1, F.lit(0)))).otherwise(F.col("positions"))})
    v = v.select("zone_id", "crs", "status", "part", "ring", F.posexplode_outer("positions").alias("seq", "p"))
    return v.select("zone_id", "crs", "part", "ring", "seq", finite(F.get("p", F.lit(0))).alias("x"), finite(F.get("p", F.lit(1))).alias("y"), "status")


def scan_zone_features(spark: SparkSession, path, id_property: str, default_crs: str | None = None, multi_line: bool = False) -> DataFrame:
    """One feature document per line, so that files are split; ``multi_line`` reads one document per file."""
    docs = spark.read.option("multiLine", multi_line).schema(FEATURES).json(path)
    return zone_vertices(docs, id_property, default_crs)


def scan_cells(blocks: DataFrame, keys: list[str], block: str, width, row0=0, column0=0, mask: str | None = None) -> DataFrame:
    """Block-stored grids (one value array per block) to cell rows with row, column, raw and mask."""
    w = col(width)
    extra = [F.get(F.col(mask), F.col("pos")).alias("mask")] if mask else []
    rows = blocks.select(*keys, w.alias("_w"), col(row0).alias("_r"), col(column0).alias("_c"), *([mask] if mask else []), F.posexplode(block).alias("pos", "v"))
    return rows.select(*keys, (F.col("_r") + F.floor(F.col("pos") / F.col("_w"))).cast("int").alias("row"), (F.col("_c") + F.col("pos") % F.col("_w")).cast("int").alias("column"), finite("v").alias("raw"), *extra)


POINT_SERIES = T.StructType([
    T.StructField("point_id", T.StringType()),
    T.StructField("header", T.StructType([T.StructField("fill_value", T.DoubleType())])),
    T.StructField("parameters", T.MapType(T.StringType(), T.StructType([T.StructField("units", T.StringType())]))),
    T.StructField("properties", T.StructType([T.StructField("parameter", T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType())))])),
])


def scan_power_points(documents: DataFrame, accepted_units: list[str], default_fill: float = -999.0) -> DataFrame:
    """Nested daily point series to rows: point_id, variable, day, value (NULL for the fill value), unit_status."""
    v = documents.select("point_id", F.coalesce("header.fill_value", F.lit(default_fill)).alias("fill"), "parameters", F.explode("properties.parameter").alias("variable", "days"))
    unit = F.col("parameters")[F.col("variable")]["units"]
    status = F.when(F.coalesce(unit.isin(*accepted_units), F.lit(False)), "OK").otherwise("UNIT_CHANGED")
    d = v.select("point_id", "variable", "fill", status.alias("unit_status"), F.explode("days").alias("_k", "_v"))
    return d.select("point_id", "variable", F.to_date("_k", "yyyyMMdd").alias("day"), F.when(F.col("_v") != F.col("fill"), finite("_v")).alias("value"), "unit_status")


#: Bytes of a file up to which it is read as one value; larger ones are streamed, so many bytes at a time.
LARGEST_FILE, STREAMED = 1 << 30, 1 << 22


def file_manifest(spark: SparkSession, folder: str, glob: str = "*", origin: str = "", largest: int = LARGEST_FILE) -> DataFrame:
    """Path (relative to the folder), size, SHA-256, origin and status of every file; files are hashed in parallel.

    Files of up to ``largest`` bytes are values of Spark's reader; larger ones are streamed through the digest, each by one task, over the
    file systems that pyarrow opens.
    """
    def streamed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for path in batch["path"]:
                scheme, rest = path.split(":", 1)
                system, name = pyarrow.fs.FileSystem.from_uri(path if rest.startswith("//") else f"{scheme}://{rest}")
                digest = hashlib.sha256()
                with system.open_input_stream(name) as f:
                    while piece := f.read(STREAMED):
                        digest.update(piece)
                found.append(digest.hexdigest())
            yield batch.assign(sha256=found)

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    small = files.load(folder).where(F.col("length") <= largest).select("path", "length", F.sha2("content", 256).alias("sha256"))
    large = files.load(folder).where(F.col("length") > largest).select("path", "length").repartition("path").mapInPandas(streamed, "path string, length long, sha256 string")
    # what comes before the folder in a path (scheme and host) goes, and the folder itself
    prefix = "^.*?\\Q/" + folder.split("://", 1)[-1].removeprefix("file:").strip("/") + "/\\E"
    return small.unionByName(large).select(F.regexp_replace("path", prefix, "").alias("path"), F.col("length").alias("size"), "sha256", F.lit(origin).alias("origin"), F.lit("OK").alias("status"))


def content_manifest(df: DataFrame, path, content, origin: str = "") -> DataFrame:
    """The same manifest of contents that stand in a table: path, size in bytes, SHA-256, origin, status."""
    body = F.coalesce(col(content).cast("string"), F.lit(""))
    return df.select(col(path).cast("string").alias("path"), F.octet_length(body).cast("long").alias("size"), F.sha2(body, 256).alias("sha256"), F.lit(origin).alias("origin"), F.lit("OK").alias("status"))
