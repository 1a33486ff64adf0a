"""Folders of runs: the last one, its tables, its metadata, and the registry of all."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightledger.session import list_names, read_bytes, write_bytes
from nightledger.sources.files import numbered_lines, path_exists, read_json_lines, write_json_lines


def latest_run(spark: SparkSession, root: str, holding: str | None = None) -> str | None:
    """The greatest name among the root's folders, of those that hold a file of the given name; None if there is none."""
    names = [n for n in sorted(list_names(spark, root), reverse=True) if not n.startswith((".", "_"))]
    return next((n for n in names if holding is None or path_exists(spark, f"{root}/{n}/{holding}")), None)


def read_run(spark: SparkSession, folder: str, schemas: Mapping[str, T.StructType]) -> tuple[dict[str, DataFrame], DataFrame]:
    """The run's tables, by name (``<name>.jsonl``), and the issues of all of them."""
    tables, issues = {}, None
    for name, schema in schemas.items():
        tables[name], found = read_json_lines(spark, f"{folder}/{name}.jsonl", schema)
        issues = found if issues is None else issues.unionByName(found)
    return tables, issues if issues is not None else spark.createDataFrame([], "line long, file string, message string, text string")


def read_artifacts(spark: SparkSession, root: str, targets: Sequence[str], name: str, schema: T.StructType) -> DataFrame:
    """(position, target, line, ...): the records of ``<root>/<target>/<name>`` of each target, in the order listed.

    Targets without the file have no rows, and lines that can't be read are passed over: one faulty file costs
    the others nothing.
    """
    there = [(i, t) for i, t in enumerate(targets, 1) if path_exists(spark, f"{root}/{t}/{name}")]
    out = T.StructType([T.StructField("position", T.IntegerType()), T.StructField("target", T.StringType()), T.StructField("line", T.LongType()), *schema.fields])
    if not there:
        return spark.createDataFrame([], out)
    broken = T.StructType([*schema.fields, T.StructField("broken_", T.StringType())])
    lines = numbered_lines(spark, [f"{root}/{t}/{name}" for _, t in there]).where(F.trim("value").startswith("{"))
    d = lines.withColumn("r", F.from_json("value", broken, {"columnNameOfCorruptRecord": "broken_"})).where("r.broken_ is null")
    # the folder that holds the file
    d = d.withColumn("target", F.url_decode(F.element_at(F.split("file", "/"), -2)))
    listed = spark.createDataFrame(there, "position int, target string")
    return d.join(F.broadcast(listed), "target").select("position", "target", "line", *[F.col("r")[f.name].alias(f.name) for f in schema.fields])


def rebuild_stream(spark: SparkSession, root: str, targets: Sequence[str], name: str, schema: T.StructType, path: str) -> None:
    """Write all targets' records anew as one stream of JSON lines, by target and line."""
    d = read_artifacts(spark, root, targets, name, schema).orderBy("position", "line").drop("position", "target", "line")
    write_json_lines(d, path)


def read_registry(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Registry entries; lines that are none are passed over, a missing file has none."""
    return read_json_lines(spark, path, schema)[0]


def read_document(spark: SparkSession, path: str, default: Any = None) -> Any:
    """A small JSON document such as a run's metadata, a search's configuration or a client's description."""
    return json.loads(read_bytes(spark, path)) if path_exists(spark, path) else default


def write_document(spark: SparkSession, path: str, document: Any) -> None:
    """A small JSON document, indented, keys in order; readers see it whole or not at all."""
    write_bytes(spark, path, (json.dumps(document, indent=2, sort_keys=True, ensure_ascii=False, default=str) + "\n").encode())


def client_profile(spark: SparkSession, document: Mapping[str, Any], schema: T.StructType) -> DataFrame:
    """A client's description as one row of the schema: unknown keys are passed over, missing ones are null."""
    return spark.createDataFrame([tuple(document.get(f.name) for f in schema.fields)], schema)
