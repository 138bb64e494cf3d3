"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(app: str = "scorewatch", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library defaults; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, or the context's checkpoint folder.

    Where neither is set and the session runs in local mode, a temporary
    folder is chosen, remembered in the session and deleted when Python ends;
    a cluster without the setting is an error.
    """
    base = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.conf.get("scorewatch.shared.dir", None)
        or spark.sparkContext.getCheckpointDir()
    )
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    base = tempfile.mkdtemp(prefix="scorewatch-")
    atexit.register(shutil.rmtree, base, True)
    spark.conf.set("scorewatch.shared.dir", base)
    return base


def scratch_dir(spark: SparkSession) -> str:
    """This application's own part of the shared folder."""
    return f"{shared_dir(spark)}/scorewatch-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the scratch folder."""
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has written to its scratch folder; earlier results read from it are gone."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df, label: str = "stage", partition_by: tuple[str, ...] = ()):
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts lineage like ``checkpoint()`` does, but keeps column pruning and
    filter push-down for the later reads, and survives the loss of executors.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_table(spark: SparkSession, rows: list[tuple], schema: str):
    """A small driver-side table as a constant relation, which needs no job of its own."""
    def literal(value) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, str):
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return f"{value!r}D" if isinstance(value, float) else repr(value)

    names = ", ".join(f"`{part.split()[0]}`" for part in schema.split(","))
    values = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")
