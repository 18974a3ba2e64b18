"""How often every term occurs and in how many records, kept up to date by signed deltas.

The state is a log of signed rows of three kinds, whose sums are the counts:
  pair    (term, record)  occurrences of the term in the record
  term    (term)          occurrences, and records that hold it
  record  (record)        pairs in it
A delta of rows (record, term, sign) is summed per pair and meets the pairs it changes in the buckets they lie in; a pair
whose count comes from or goes to zero changes the record count of its term, and so on. What is written is the change
alone; rows of before stay where they are, so a delta costs what it touches. Once the changes of a kind are more than
COMPACT of its rows, its log is summed up into new buckets, of about ROWS rows each. Pairs are bucketed by both of their
parts, so that neither a term nor a record of a third of all rows fills a bucket of its own.

A delta is published by one write of the manifest, after all of it is written: a reader sees the state before or after
it. Folders that the manifest doesn't name any more are deleted then.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vicinage.session import delete, table_path

#: Rows of a bucket, buckets at most, and the share of changed rows from which a log is summed up.
ROWS, BUCKETS, COMPACT = 1_000_000, 4096, 0.5
KINDS = {"pair": ["term", "rec"], "term": ["term"], "record": ["rec"]}
ROW = "term bigint, rec string, n bigint, recs bigint, bucket int"


def signed(added: DataFrame | None = None, deleted: DataFrame | None = None) -> DataFrame:
    """(rec, term, sign) of rows (rec, term) that came in or went away; a changed row is its old form deleted and its
    new form added."""
    parts = [df.select(F.col("rec").cast("string").alias("rec"), F.col("term").cast("bigint").alias("term"), F.lit(s).alias("sign")) for df, s in ((added, 1), (deleted, -1)) if df is not None]
    if not parts:
        raise ValueError("a delta needs added or deleted rows")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


class TermCounts:
    """The persistent counts. Rows with a null record or term never count. Deleting more than there is raises an
    error when the delta is applied, and leaves the state as it was. An empty delta changes nothing."""

    def __init__(self, spark: SparkSession, path: str | None = None, rows: int = ROWS) -> None:
        self.spark, self.path, self.rows = spark, path or table_path(spark, "termcounts"), rows
        #: kind -> its folders, the summed one first; kind -> rows in the first and in the others; kind -> buckets
        self.live: dict[str, list[str]] = {k: [] for k in KINDS}
        self.sizes: dict[str, list[int]] = {k: [0, 0] for k in KINDS}
        self.buckets: dict[str, int] = dict.fromkeys(KINDS, 1)
        self.generation = 0

    def _manifest(self) -> tuple:
        fs_path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest.json")  # noqa: SLF001
        return fs_path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), fs_path  # noqa: SLF001

    def _publish(self, live: dict, sizes: dict, buckets: dict, generation: int) -> None:
        fs, p = self._manifest()
        out = fs.create(p, True)
        out.write(bytearray(json.dumps({"generation": generation, "rows": self.rows, "live": live, "sizes": sizes, "buckets": buckets}).encode()))
        out.close()
        gone = {f for fs_ in self.live.values() for f in fs_} - {f for fs_ in live.values() for f in fs_}
        self.live, self.sizes, self.buckets, self.generation = live, sizes, buckets, generation
        for f in gone:
            delete(self.spark, f)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TermCounts:
        state = json.loads("\n".join(r[0] for r in spark.read.text(f"{path}/manifest.json").collect()))
        own = cls(spark, path, state["rows"])
        own.generation, own.live, own.sizes, own.buckets = state["generation"], state["live"], state["sizes"], state["buckets"]
        return own

    def _bucket(self, kind: str, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*KINDS[kind]), F.lit(buckets)).cast("int")

    def _read(self, kind: str, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], ROW)
        return self.spark.read.schema(ROW).option("basePath", self.path).parquet(*folders).select("term", "rec", "n", "recs", "bucket")

    def _write(self, kind: str, changes: DataFrame, buckets: int, where: str) -> int:
        """Writes rows (keys, n, recs) by bucket; the number of rows."""
        keys = KINDS[kind]
        rest = [F.lit(None).cast(t).alias(c) for c, t in (("term", "bigint"), ("rec", "string")) if c not in keys]
        out = changes.select(*keys, *rest, F.col("n").cast("bigint").alias("n"), F.col("recs").cast("bigint").alias("recs"), self._bucket(kind, buckets).alias("bucket"))
        if buckets > 1:
            out = out.repartition("bucket", F.pmod(F.xxhash64(*keys) / buckets, F.lit(4)).cast("int"))
        out.write.partitionBy("bucket").parquet(where)
        return self._read(kind, [where]).count()

    def apply(self, delta: DataFrame) -> None:
        """delta: (rec, term, sign); sign 1 for an added, -1 for a deleted occurrence."""
        generation = self.generation + 1
        folder = lambda kind, what: f"{self.path}/kind={kind}/log={generation}-{what}"
        live, sizes, buckets = {k: list(v) for k, v in self.live.items()}, {k: list(v) for k, v in self.sizes.items()}, dict(self.buckets)
        made: list[str] = []
        try:
            delta = delta.where("rec is not null and term is not null")
            if not live["pair"]:  # a first load says how many buckets there are
                n = delta.count()
                buckets = dict.fromkeys(KINDS, max(1, min(BUCKETS, -(-n // self.rows))))
            sums = delta.groupBy("term", "rec").agg(F.sum(F.col("sign").cast("bigint")).alias("n")).where("n <> 0").withColumn("recs", F.lit(0))
            if live["pair"]:
                made.append(folder("pair", "delta"))
                self._write("pair", sums, buckets["pair"], made[-1])
                sums = self._read("pair", [made[-1]])
                touched = [r[0] for r in sums.select("bucket").distinct().collect()]
                changed = sums.select("bucket", "term", "rec").withColumn("mine", F.lit(True))
                before = self._read("pair", live["pair"]).where(F.col("bucket").isin(touched)).join(changed, ["bucket", "term", "rec"], "left_semi")
                old = before.groupBy("term", "rec").agg(F.sum("n").alias("n0"))
                sums = sums.select("term", "rec", "n").join(old, ["term", "rec"], "left")
            else:
                sums = sums.withColumn("n0", F.lit(0))
            n0 = F.coalesce("n0", F.lit(0))
            now = F.col("n") + n0
            checked = F.when(now < 0, F.raise_error(F.concat(F.lit("pair: more deleted than there is of "), F.col("term").cast("string"), F.lit("/"), "rec"))).otherwise(F.col("n"))
            pairs = sums.select("term", "rec", checked.alias("n"), ((now > 0).cast("int") - (n0 > 0).cast("int")).alias("recs"))
            steps = {"pair": pairs}
            for kind in KINDS:
                where = folder(kind, "changes")
                made.append(where)
                n = self._write(kind, steps[kind], buckets[kind], where)
                live[kind].append(where)
                sizes[kind][len(live[kind]) > 1] += n
                if kind == "pair":
                    written = self._read("pair", [where])
                    steps["term"] = written.groupBy("term").agg(F.sum("n").alias("n"), F.sum("recs").alias("recs"))
                    steps["record"] = written.groupBy("rec").agg(F.sum("recs").alias("n"), F.lit(0).alias("recs")).where("n <> 0")
            for kind, keys in KINDS.items():
                base, extra = sizes[kind]
                if extra > COMPACT * base and len(live[kind]) > 1:
                    where = folder(kind, "base")
                    made.append(where)
                    total = self._read(kind, live[kind]).groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("recs").alias("recs")).where("n <> 0 or recs <> 0")
                    buckets[kind] = max(1, min(BUCKETS, -(-(base + extra) // self.rows)))
                    live[kind], sizes[kind] = [where], [self._write(kind, total, buckets[kind], where), 0]
        except Exception:
            for f in made:
                delete(self.spark, f)
            raise
        self._publish(live, sizes, buckets, generation)
        for f in made:
            if not any(f in fs for fs in live.values()):
                delete(self.spark, f)

    def counts(self) -> DataFrame:
        """(term, n_rows, n_records) of the terms there are now."""
        now = self._read("term", self.live["term"]).groupBy("term").agg(F.sum("n").alias("n_rows"), F.sum("recs").alias("n_records"))
        return now.where("n_rows > 0")

    def n_records(self) -> int:
        """Records with a term."""
        return self._read("record", self.live["record"]).groupBy("rec").agg(F.sum("n").alias("n")).where("n > 0").count()

    def marked(self, rare_below: int = 3, common_share: float = 0.2) -> DataFrame:
        """(term, n_rows, n_records, mark): rare for terms in fewer than rare_below records, common for terms in more
        than ceil(common_share * records); else mark is null. A term that is both is rare."""
        many = -(-round(self.n_records() * common_share * 10**9) // 10**9)
        mark = F.when(F.col("n_records") < rare_below, "rare").when(F.col("n_records") > many, "common")
        return self.counts().withColumn("mark", mark)
