"""Session settings and tables written in the cluster's shared folder."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", app: str = "vicinage") -> SparkSession:
    """A session for tests and benches on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or on a local master a temporary one of our own."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    found = getattr(spark, "_vicinage_shared", None)
    if found is None:
        found = "file://" + tempfile.mkdtemp(prefix="vicinage-")
        spark._vicinage_shared = found  # noqa: SLF001
        spark.sparkContext._jvm.org.apache.spark.util.ShutdownHookManager.registerShutdownDeleteDir(spark.sparkContext._jvm.java.io.File(found[7:]))  # noqa: SLF001
    return found


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared storage, if it is there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)  # noqa: SLF001


def _folder(spark: SparkSession) -> str:
    """This application's own folder in the shared one; removed when Python ends, if the session still lives then."""
    folder = f"{shared_dir(spark)}/vicinage-{spark.sparkContext.applicationId}"
    if getattr(spark, "_vicinage_folder", None) != folder:
        spark._vicinage_folder = folder  # noqa: SLF001

        def remove() -> None:
            with contextlib.suppress(Exception):
                delete(spark, folder)

        atexit.register(remove)
    return folder


def table_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it again: lineage ends there, and a lost executor costs nothing."""
    path = table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Deletes the files of a table made by cut(), once nothing reads it any more."""
    for folder in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        delete(df.sparkSession, folder)
