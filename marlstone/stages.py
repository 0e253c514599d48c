"""Materialised stages and skew-safe joins shared by the operators.

Operators that cut lineage write stages, so building such an operator's result runs jobs; only the last part is lazy.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}
#: Paths of the stages of this process, by the identity of their frames and in order of writing.
_PATHS: dict[int, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir; where it is unset, a temporary one with a local master.

    On a cluster without spark.checkpoint.dir this raises: executors couldn't read one another's stages.
    """
    told = spark.conf.get("spark.checkpoint.dir", None)
    if told:
        return told.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="marlstone-")
    return _OWN[app]


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, a lost executor costs nothing already done."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._marlstone_stage = path
    if not _PATHS:
        atexit.register(_clear_at_exit)
    _PATHS[id(back)] = path
    return back


def _clear_at_exit() -> None:
    """Stages in a folder that this machine sees are deleted when the process ends; those elsewhere by clear_stages."""
    for path in _PATHS.values():
        if path.startswith(("file:", "/")):
            shutil.rmtree(path.removeprefix("file:").replace("//", "/"), ignore_errors=True)


def counted(df: DataFrame, *aggregates: Column) -> tuple[DataFrame, tuple]:
    """stage(df), and its number of rows and other ``aggregates``, taken while it is written: no job of their own."""
    seen = Observation()
    names = [f"_{k}" for k in range(len(aggregates))]
    back = stage(df.observe(seen, F.count(F.lit(1)).alias("_n"), *[a.alias(n) for a, n in zip(aggregates, names, strict=True)]))
    got = seen.get
    return back, tuple(got[n] for n in ["_n", *names])


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def drop_stage(*stages: DataFrame) -> None:
    """Delete stages that nothing unwritten reads any more; frames that aren't stages are left alone."""
    for df in stages:
        path = getattr(df, "_marlstone_stage", None)
        if path:
            _PATHS.pop(id(df), None)
            _delete(df.sparkSession, path)


def clear_stages(spark: SparkSession) -> None:
    """Delete every stage of this process; call it once the results that read them are written."""
    for path in list(_PATHS.values()):
        _delete(spark, path)
    _PATHS.clear()


#: Bytes of keys and values up to which a dimension may be broadcast.
BROADCAST_BYTES = 16 << 20


def bytes_of(df: DataFrame) -> Column:
    """About the bytes of all rows of ``df``, as an aggregate."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns), F.lit(0))
    return F.coalesce(F.sum(width), F.lit(0).cast("long"))


def size_of(df: DataFrame, *more: Column) -> tuple:
    """Rows and about the bytes of ``df``, then ``more`` aggregates of it, in one job."""
    return tuple(df.agg(F.count(F.lit(1)), bytes_of(df), *more).first())


def measured(dim: DataFrame, counts: str) -> tuple:
    """Rows and bytes of a dimension and the rows that it counts, for with_dim."""
    return size_of(dim, F.coalesce(F.sum(counts), F.lit(0)))


def with_dim(rows: DataFrame, dim: DataFrame, key: str, counts: str, share: int = 64, most_bytes: int | None = None, sizes: tuple | None = None) -> DataFrame:
    """Left-join the staged dimension ``dim`` (unique string ``key``, column ``counts`` = rows of that key) without skew: rows' columns, then dim's.

    A dimension of at most ``most_bytes`` (BROADCAST_BYTES) is broadcast. Beyond that, keys that hold more than 1/share
    of all counted rows are at most ``share`` many, so they alone are broadcast; their rows and those without key get a
    spread key in the shuffled join, in which no key then holds more than 1/share. Rows, columns and their order are
    the same either way. ``sizes`` is measured(dim, counts), where it is known.
    """
    _, size, total = sizes or measured(dim, counts)
    values = [c for c in dim.columns if c not in (key, counts)]
    if size <= (BROADCAST_BYTES if most_bytes is None else most_bytes):
        return rows.join(F.broadcast(dim.drop(counts)), key, "left").select(*rows.columns, *values)
    held = F.struct(*values)
    hot = dim.filter(F.col(counts) > total / share).select(F.col(key).alias("_hk"), held.alias("_hv"))
    cold = dim.filter(F.col(counts) <= total / share).select(F.concat(F.lit("k"), F.col(key).cast("string")).alias("_ck"), held.alias("_cv"))
    spread = F.when(F.col("_hk").isNotNull() | F.col(key).isNull(), F.concat(F.lit("s"), F.monotonically_increasing_id().cast("string"))).otherwise(F.concat(F.lit("k"), F.col(key).cast("string")))
    joined = rows.join(F.broadcast(hot), F.col(key) == F.col("_hk"), "left").withColumn("_jk", spread)
    joined = joined.join(cold, F.col("_jk") == F.col("_ck"), "left").withColumn("_v", F.coalesce("_hv", "_cv"))
    return joined.select(*rows.columns, *[F.col(f"_v.{v}").alias(v) for v in values])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Every kind of blank, for Java character classes (white space, separators, zero-width marks).
BLANK = r"\s\p{Z}\x{85}\x{200B}\x{2060}\x{FEFF}"


def strip_blanks(c: Column) -> Column:
    """``c`` without blanks of any kind at either end (Unicode spaces too, which trim() leaves)."""
    return F.regexp_replace(c, rf"^[{BLANK}]+|[{BLANK}]++$", "")
