"""Written intermediate tables: reuse between runs, and a cut in the lineage that survives lost executors."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="wardloom-")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints. Only a local session may fall back to a folder of its own."""
    named = spark.conf.get(SETTING, None)
    if named:
        return named
    if spark.sparkContext.master.startswith("local"):
        return _local_folder()
    raise ValueError(f"set {SETTING} to a folder that every executor reaches")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    path = f"{shared_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass
class RowCount:
    """Rows of a kept table, counted by the write itself."""

    seen: Observation | None = None

    def watch(self, df: DataFrame) -> DataFrame:
        """``df``, which must be written next."""
        self.seen = Observation()
        return df.observe(self.seen, F.count(F.lit(1)).alias("rows"))

    def of(self, table: DataFrame) -> int:
        """What the write has counted, or the figures in the files' footers where the table was there already."""
        return table.count() if self.seen is None else self.seen.get["rows"]


def fingerprint(*parts) -> str:
    """Short key for whatever decides a stage's content: parameters, specs, input paths."""
    return hashlib.sha256(repr(parts).encode()).hexdigest()[:16]


def content_key(df: DataFrame | None) -> str | None:
    """A key for the rows of a table, in any order."""
    if df is None:
        return None
    row = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    found = df.agg(F.count(F.lit(1)), F.sum(row.cast("decimal(38,0)")), F.bit_xor(F.xxhash64(row, F.lit(1)))).first()
    return fingerprint(sorted(df.dtypes), *[str(x) for x in found])


def exists(spark: SparkSession, path: str) -> bool:
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    return named.getFileSystem(spark._jsc.hadoopConfiguration()).exists(named)


def stage(df: DataFrame, name: str, key: str, root: str | None = None, counted: RowCount | None = None) -> DataFrame:
    """Read stage ``name`` if it was completely written under the same key, else write it first. ``counted`` watches the write."""
    spark = df.sparkSession
    path = f"{root or shared_folder(spark)}/{name}-{key}"
    if not exists(spark, f"{path}/_SUCCESS"):
        (counted.watch(df) if counted else df).write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# --- stages that are rewritten in part ------------------------------------------------------------------------------

BUCKET = "_bucket"
REGISTER = "bucket int, content string, part string, empty boolean, number long"


def _register(spark: SparkSession, home: str) -> DataFrame:
    there = exists(spark, f"{home}/register/_SUCCESS")
    return spark.read.schema(REGISTER).parquet(f"{home}/register") if there else spark.createDataFrame([], REGISTER)


def stage_by_bucket(
    rows: DataFrame, keys: Sequence[str], compute: Callable[[DataFrame], DataFrame], name: str, key: str, buckets: int = 256, root: str | None = None
) -> DataFrame:
    """``compute(rows)``, kept by buckets of the rows' ``keys`` and made anew only for buckets whose rows are not what they were.

    ``compute`` must treat the rows of different keys apart and keep the columns ``keys``. ``key`` stands for everything else that decides the result. The content of
    each bucket is hashed in one pass over the rows, in any order. Changed buckets are written to a part of their own, and the register, appended last,
    makes them the ones that are read; a run that breaks off before changes nothing.
    """
    spark = rows.sparkSession
    home = f"{root or shared_folder(spark)}/{name}-{key}-{buckets}"
    own = F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in keys]), F.lit(buckets)).cast("int")
    row = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(rows.columns)])
    sums = rows.select(own.alias(BUCKET), row.alias("h")).groupBy(BUCKET).agg(F.count(F.lit(1)), F.sum(F.col("h").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("h", F.lit(1))))
    content = {r[0]: fingerprint(*[str(x) for x in r[1:]]) for r in sums.collect()}  # a row for each bucket
    known: dict[int, Row] = {}
    for r in _register(spark, home).orderBy("number").collect():
        known[r["bucket"]] = r
    changed = sorted(b for b, c in content.items() if b not in known or known[b]["content"] != c)
    made = compute(rows.where(own.isin(changed)) if changed else rows.limit(0))
    if changed:
        part = uuid.uuid4().hex
        made.withColumn(BUCKET, own).write.partitionBy(BUCKET).parquet(f"{home}/part={part}")
        number = max((r["number"] for r in known.values()), default=0) + 1
        entries = [(b, content[b], part, not exists(spark, f"{home}/part={part}/{BUCKET}={b}"), number) for b in changed]
        spark.createDataFrame(entries, REGISTER).coalesce(1).write.mode("append").parquet(f"{home}/register")
        known |= {e[0]: Row(**dict(zip(("bucket", "content", "part", "empty", "number"), e))) for e in entries}
    paths = [f"{home}/part={known[b]['part']}/{BUCKET}={b}" for b in sorted(content) if not known[b]["empty"]]
    return spark.read.schema(made.schema).parquet(*paths) if paths else spark.createDataFrame([], made.schema)


def sweep_parts(spark: SparkSession, name: str, key: str, buckets: int = 256, root: str | None = None) -> list[str]:
    """Remove the buckets that the register of a stage no longer names; nobody may be reading an older state. Returns what was removed."""
    home = f"{root or shared_folder(spark)}/{name}-{key}-{buckets}"
    named: dict[int, str] = {}
    for r in _register(spark, home).orderBy("number").collect():
        named[r["bucket"]] = r["part"]
    used = {f"part={p}/{BUCKET}={b}" for b, p in named.items()}
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(home).getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for part in files.listStatus(path(home)) if files.exists(path(home)) else ():
        if part.getPath().getName().startswith("part="):
            for bucket in files.listStatus(part.getPath()):
                place = f"{part.getPath().getName()}/{bucket.getPath().getName()}"
                if bucket.isDirectory() and place not in used:
                    files.delete(bucket.getPath(), True)
                    gone.append(place)
    return sorted(gone)
