"""Writers of the output tables (survey ids SNK-01..10)."""

from __future__ import annotations

import base64
import gzip
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vicinage.functions.text import wrapped

#: Tables of the output bundle, and whether their TSV twin has a header (fixed values).
BUNDLE = {
    "gff": False,
    "hoods": True,
    "protein_metadata": True,
    "tree_metadata": True,
    "domains": False,
    "domains_metadata": True,
    "ncrna_metadata": True,
    "nucleotide_links": False,
    "protein_links": False,
}


def _files(df: DataFrame):  # noqa: ANN202
    """The Hadoop file system handle and a path maker."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001
    return (lambda p: jvm.org.apache.hadoop.fs.Path(p)), (lambda p: jvm.org.apache.hadoop.fs.Path(p).getFileSystem(conf))


def write_tsv(df: DataFrame, path: str, header: bool, always_quote: bool = False) -> None:
    """TSV parts; nulls are empty; quotes only where needed; outer blanks are kept."""
    df.write.mode("overwrite").option("sep", "\t").option("header", header).option("quoteAll", always_quote).option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_parquet(df: DataFrame, path: str, rows_per_file: int | None = None) -> None:
    """Zstandard Parquet; void columns become text, as Parquet has no void."""
    typed = df.withColumns({c: F.col(c).cast("string") for c, t in df.dtypes if t == "void"})
    w = typed.write.mode("overwrite").option("compression", "zstd")
    (w.option("maxRecordsPerFile", rows_per_file) if rows_per_file else w).parquet(path)


def write_bundle(tables: dict[str, DataFrame], out: str, empty: dict[str, str], spark=None) -> None:  # noqa: ANN001
    """Every table of BUNDLE as Parquet and TSV; a table that isn't given is written empty with its schema."""
    for name, header in BUNDLE.items():
        df = tables.get(name)
        if df is None:
            df = (spark or next(iter(tables.values())).sparkSession).createDataFrame([], empty[name])
        write_parquet(df, f"{out}/{name}.parquet")
        write_tsv(df, f"{out}/{name}.tsv", header)


def publish(df: DataFrame, target: str, writer: Callable[[DataFrame, str], None] = write_parquet, validate: Callable[[DataFrame], None] | None = None) -> None:
    """Writes beside the target, validates, then swaps by rename. On an error the target stays as it was and the staging
    folder is kept for a look."""
    path, fs = _files(df)
    stage, old = f"{target}.staging", f"{target}.old"
    files = fs(target)
    files.delete(path(stage), True)
    writer(df, stage)
    if validate:
        validate(df.sparkSession.read.parquet(stage))
    files.delete(path(old), True)
    if files.exists(path(target)):
        files.rename(path(target), path(old))
    if not files.rename(path(stage), path(target)):
        files.rename(path(old), path(target))
        raise OSError(f"couldn't publish {target}")
    files.delete(path(old), True)


def write_fasta(df: DataFrame, path: str, ident: str = "id", sequence: str = "sequence", width: int | None = 80) -> None:
    body = wrapped(F.col(sequence), width) if width else F.col(sequence)
    df.where(F.col(sequence).isNotNull()).select(F.concat(F.lit(">"), F.col(ident), F.lit("\n"), body).alias("value")).write.mode("overwrite").text(path)


def write_run_table(df: DataFrame, path: str) -> None:
    """A table of a run as headed TSV without its sequence column, cells quoted only where needed."""
    write_tsv(df.drop("sequence"), path, True)


def clean_up(spark: SparkSession, folder: str, keep: tuple[str, ...]) -> list[str]:
    """Deletes what lies in a run's folder but for the names to keep; the names that are left, in order."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001
    where = jvm.org.apache.hadoop.fs.Path(folder)
    files = where.getFileSystem(conf)
    for status in files.listStatus(where):
        if status.getPath().getName() not in keep:
            files.delete(status.getPath(), True)
    return sorted(status.getPath().getName() for status in files.listStatus(where))


def append_trace(df: DataFrame, path: str, stage: str) -> None:
    """Rows added to a debug log with the stage they come from."""
    df.select(F.lit(stage).alias("stage"), *[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]).write.mode("append").option("header", True).csv(path)


def embed(data: bytes) -> str:
    """Text form of bytes for a page that holds its own data."""
    return base64.b64encode(gzip.compress(data, mtime=0)).decode()


def unembed(text: str) -> bytes:
    return gzip.decompress(base64.b64decode(text))
