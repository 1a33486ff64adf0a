"""Session settings and the shared folder in which intermediate tables live."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("nightledger")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Where it is unset, a local master gets a temporary folder of its own; any other master is an
    error, because a folder of one machine would be lost with it.
    """
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        fs, target = _on_files(spark, given.rstrip("/"))
        return fs.makeQualified(target).toString()  # with its scheme, so that all parts of Spark take it for the same
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = "file://" + tempfile.mkdtemp(prefix="nightledger-")
        atexit.register(_remove_local, _own_dirs[app])
    return _own_dirs[app]


def _remove_local(path: str) -> None:
    import shutil

    shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)


_made: dict[str, list[str]] = {}


def new_table_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/nightledger/{name}-{uuid.uuid4().hex[:12]}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> None:
    """Remove all intermediate tables made so far. Results that were not collected or written yet are lost with them."""
    for path in _made.pop(spark.sparkContext.applicationId, []):
        remove_path(spark, path)


def _on_files(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def remove_path(spark: SparkSession, path: str) -> None:
    fs, target = _on_files(spark, path)
    fs.delete(target, True)
    made = _made.get(spark.sparkContext.applicationId, [])
    if path in made:
        made.remove(path)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file, which readers see whole or not at all."""
    fs, target = _on_files(spark, path)
    _, part = _on_files(spark, f"{path}.part-{uuid.uuid4().hex[:8]}")
    out = fs.create(part, True)
    try:
        for k in range(0, len(data), 1 << 20):
            out.write(bytearray(data[k : k + (1 << 20)]))
    finally:
        out.close()
    fs.delete(target, False)
    if not fs.rename(part, target):
        raise OSError(f"can't write {path}")


def read_bytes(spark: SparkSession, path: str) -> bytes:
    fs, target = _on_files(spark, path)
    stream = fs.open(target)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none where it is missing."""
    fs, target = _on_files(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def store(df: DataFrame, name: str, partition_by: list[str] | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` once into the shared folder and read it back.

    This cuts the lineage, survives the loss of executors, and unlike ``checkpoint()`` runs the plan
    once and keeps the rows columnar. Returns the table and its path for ``remove_path``.
    """
    spark = df.sparkSession
    path = new_table_path(spark, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


_shipped: set[str] = set()


def ship_file(spark: SparkSession, name: str, data: bytes) -> str:
    """Hand a small file to all executors, by way of the shared folder. Returns its name for ``SparkFiles.get``."""
    name = f"{uuid.uuid4().hex[:12]}-{name}"
    path = f"{shared_dir(spark)}/nightledger/{name}"
    write_bytes(spark, path, data)
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    spark.sparkContext.addFile(path)
    return name


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once for each application: executors needn't have it installed."""
    import io
    import zipfile
    from pathlib import Path

    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    path = f"{shared_dir(spark)}/nightledger/code-{uuid.uuid4().hex[:12]}.zip"
    write_bytes(spark, path, packed.getvalue())
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
