"""Reading and writing of tables outside Parquet folders, with what may go wrong as data."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightledger.session import list_names, read_bytes, remove_path, write_bytes


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> tuple[DataFrame, str]:
    """The Parquet table and ``ready``, or an empty one of the schema and ``missing``."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path), "ready"
    return spark.createDataFrame([], schema), "missing"


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, line, value): every line of text files with its number from 1.

    A file may be read in any number of splits: lines are numbered within each, and moved by the lines of the
    splits before it.
    """
    d = spark.read.text(path).select("value", F.input_file_name().alias("file"), F.input_file_block_start().alias("at"), F.monotonically_increasing_id().alias("id"))
    splits = d.groupBy("file", "at").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)  # one row a split
    splits = splits.select("file", "at", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return d.join(splits, ["file", "at"]).select("file", (F.col("id") - F.col("first") + F.col("before") + 1).alias("line"), "value")


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records, issues) of JSON lines: blank lines are skipped, lines that are no object are issues.

    Issues have ``line``, ``file``, ``message`` and the line's ``text``. A missing path gives no records and one
    issue; with ``strict`` it gives neither, and the first broken line is an error.
    """
    if not path_exists(spark, path):
        gone = [] if strict else [(None, path, "the file is missing", None)]
        return spark.createDataFrame([], schema), spark.createDataFrame(gone, "line long, file string, message string, text string")
    broken = T.StructType([*schema.fields, T.StructField("broken_", T.StringType())])

    def parsed(lines: DataFrame) -> tuple[DataFrame, Column]:
        d = lines.where(F.trim("value") != "")
        d = d.withColumn("r", F.from_json("value", broken, {"columnNameOfCorruptRecord": "broken_", "mode": "PERMISSIVE"}))
        return d, F.col("r.broken_").isNotNull() | ~F.trim("value").startswith("{")

    lines, bad = parsed(spark.read.text(path))
    records = lines.where(~bad).select(*[F.col("r")[f.name].alias(f.name) for f in schema.fields])
    numbered, bad = parsed(numbered_lines(spark, path))
    message = F.when(F.trim("value").startswith("{"), "the line can't be parsed").otherwise("the line is no object")
    issues = numbered.where(bad).select("line", "file", message.alias("message"), F.col("value").alias("text"))
    if strict and (first := issues.orderBy("file", "line").first()) is not None:
        raise ValueError(f"{first['file']}:{first['line']}: {first['message']}")
    return records, issues


def write_json_lines(rows: DataFrame, path: str, append: bool = False) -> None:
    rows.write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)


def read_csv_text(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV with a header, every column as text; a missing file is an empty table."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def encode_nested(rows: DataFrame) -> DataFrame:
    """Arrays, maps and structs as JSON text, maps in the order of their keys; nulls stay null."""
    out = {}
    for f in rows.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.MapType):
            c = F.map_from_entries(F.array_sort(F.map_entries(c)))
        if isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType)):
            out[f.name] = F.to_json(c)
    return rows.withColumns(out) if out else rows


def decode_nested(rows: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """JSON text as nested columns; text that can't be read as its type is an error naming the column."""
    out = {}
    for name, kind in types.items():
        v = F.from_json(name, kind)
        out[name] = F.when(F.col(name).isNotNull() & v.isNull(), F.raise_error(F.lit(f"{name} holds invalid JSON"))).otherwise(v)
    return rows.withColumns(out)


class VersionedTable:
    """A table of which readers see whole versions: each write is a folder of its own, then a pointer moves."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _version(self) -> int:
        return max((int(n) for n in list_names(self.spark, f"{self.path}/current") if n.isdigit()), default=0)

    def read(self, schema: T.StructType | str) -> DataFrame:
        v = self._version()
        return self.spark.read.schema(schema).parquet(f"{self.path}/v{v}") if v else self.spark.createDataFrame([], schema)

    def write(self, rows: DataFrame) -> int:
        """Write the next version, which may be computed from this one, and keep the last but one."""
        v = self._version() + 1
        rows.write.mode("overwrite").parquet(f"{self.path}/v{v}")
        write_bytes(self.spark, f"{self.path}/current/{v}", b"")
        if v > 2:
            remove_path(self.spark, f"{self.path}/current/{v - 2}")
            remove_path(self.spark, f"{self.path}/v{v - 2}")
        return v


class BucketedTable:
    """A keyed table in buckets of its key's hash. A write replaces the buckets it touches; readers see whole versions.

    The manifest of each version, a small file written last of all, says which folder holds which bucket.
    """

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], schema: T.StructType, buckets: int = 64):
        self.spark, self.path, self.key, self.schema, self.buckets = spark, path, list(key), schema, buckets

    def _manifest(self) -> tuple[int, dict[str, int]]:
        versions = [int(n) for n in list_names(self.spark, f"{self.path}/current") if n.isdigit()]
        return (max(versions), json.loads(read_bytes(self.spark, f"{self.path}/current/{max(versions)}"))) if versions else (0, {})

    def _folders(self, held: dict[str, int], buckets: Sequence[str]) -> DataFrame:
        folders = [f"{self.path}/v{held[b]}/bucket_={b}" for b in buckets if b in held]
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def read(self) -> DataFrame:
        _, held = self._manifest()
        return self._folders(held, list(held))

    def rewrite(self, rows: DataFrame, fold: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """Replace the buckets that ``rows`` have keys in by ``fold(old rows of these, rows)``; returns the buckets touched."""
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets))
        touched = sorted(str(r[0]) for r in rows.select(bucket).distinct().collect())  # at most as many as there are
        if not touched:
            return 0
        version, held = self._manifest()
        version += 1
        new = fold(self._folders(held, touched), rows.select(*self.schema.names)).select(*self.schema.names)
        new.withColumn("bucket_", bucket).repartition("bucket_").write.mode("overwrite").partitionBy("bucket_").parquet(f"{self.path}/v{version}")
        write_bytes(self.spark, f"{self.path}/current/{version}", json.dumps(held | {b: version for b in touched}).encode())
        # what the version before last needed and neither of these does
        for b in touched:
            old = held.get(b)
            if old is not None and old < version - 1:
                remove_path(self.spark, f"{self.path}/v{old}/bucket_={b}")
        if version > 2:
            remove_path(self.spark, f"{self.path}/current/{version - 2}")
        return len(touched)
