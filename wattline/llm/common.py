"""Helpers that several operators of this subpackage share.

Intermediate results that more than one job reads are written as Parquet under
the shared folder named by ``spark.checkpoint.dir`` (set only where it is
unset, as in tests). A written table cuts the lineage, so a lost executor
costs only the running stage, and row numbers that were assigned before the
write are fixed for every later reader.
"""
from __future__ import annotations

import contextlib
import math
import sys
import types
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattline.session import checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for one table below the session's shared folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)
    return f"{base.rstrip('/')}/wattline-llm/{name}-{uuid.uuid4().hex}"


#: The setting that bounds the rows of a batch on its way to a Python worker.
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Groups that a collecting aggregate keeps in a hash map before it sorts instead.
HASH_GROUPS = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"


#: Paths of the tables written inside the open ``temporaries`` blocks, innermost last.
_OPEN: list[list[str]] = []


@contextlib.contextmanager
def temporaries(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete the tables that ``stored`` writes inside the block when it ends well.

    The block gets a function that stores a table outside: a result that stays.
    Nothing that is read later may depend on the others.
    """
    _OPEN.append(written := [])

    def close() -> None:
        _OPEN[:] = [w for w in _OPEN if w is not written]

    def keep(df: DataFrame, name: str) -> DataFrame:
        close()
        try:
            return stored(df, name)
        finally:
            _OPEN.append(written)
    try:
        yield keep
    finally:
        close()
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for path in written:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(hadoop).delete(folder, True)


def stored(df: DataFrame, name: str, **settings: tuple[str, int]) -> DataFrame:
    """Write ``df`` as a shared Parquet table and return a reader of it.

    ``settings`` (each a Spark setting and its value) hold for this write only,
    such as smaller batches for rows that hold blocks of vectors.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    before = {key: spark.conf.get(key) for key, _ in settings.values()}
    try:
        for key, value in settings.values():
            spark.conf.set(key, value)
        if _OPEN:
            _OPEN[-1].append(path)
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of two or three numbers that are worth a task of their own.
GATHERED_ROWS = 20_000


def gathered(df: DataFrame, rows: int) -> DataFrame:
    """``df``, which holds ``rows`` rows of a few numbers at most, in no more tasks than these keep busy.

    A shuffle can leave many partitions of a few rows each, and each would be a task and a file.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / GATHERED_ROWS)))


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files that nothing refers to any more.

    It does so when the driver's JVM collects its garbage, which a roomy heap
    seldom needs; a loop whose rounds are stored would keep the files of all of them.
    """
    spark.sparkContext._jvm.System.gc()


#: Whole texts that a batch on its way to a Python worker may hold; long texts make larger batches costly.
TEXT_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Keep the session's batches of texts small, unless it has set them smaller.

    It must hold until the caller's action, so it stays set.
    """
    if int(spark.conf.get(ARROW_ROWS)) > TEXT_ROWS:
        spark.conf.set(ARROW_ROWS, TEXT_ROWS)


def per_process(kind: str, name: str, make: Callable[[], object]) -> object:
    """An object that the tasks of one Python worker process share; one name of a kind is held at a time."""
    held = sys.modules.setdefault("wattline_worker_state", types.ModuleType("wattline_worker_state"))
    if getattr(held, kind, (None, None))[0] != name:
        setattr(held, kind, (name, make()))
    return getattr(held, kind)[1]


def text_or_empty(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def unit_hash(seed: int, *cols) -> Column:
    """Uniform number in [0, 1) from a seed and the columns (53 bits, exact)."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11) / F.lit(float(1 << 53))


def bucket_offsets(counts: DataFrame, keys: list[str], bucket: str, n: str, out: str) -> DataFrame:
    """Rows of the same ``keys`` in smaller buckets: one row per key and bucket.

    ``counts`` holds one row per (keys, bucket), so the window works on bucket
    counts, never on the rows themselves.
    """
    w = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(out, F.coalesce(F.sum(n).over(w), F.lit(0).cast("long")))


def row_mark(key: str, text: str) -> Column:
    """128 bits that stand for a document's row: its doc_id and its whole text, either of them null or not."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("null")),
                                  F.coalesce(F.concat(F.lit("\t"), F.col(text)), F.lit("")))))


def apply_decisions(docs: DataFrame, decisions: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) that ``decisions`` (mark, repeats) keeps, ``repeats`` times each.

    Rows that share a mark are equal in doc_id and text: the first of them by
    the hash of all columns stands for all.
    """
    kept = decisions.groupBy("mark").agg(F.sum("repeats").cast("int").alias("repeats")).where("repeats > 0")
    rows = docs.select(row_mark(key, text).alias("mark"), F.struct(*docs.columns).alias("row")).join(kept, "mark")
    rank = F.row_number().over(Window.partitionBy("mark").orderBy(F.xxhash64("row")))
    rows = rows.withColumn("rank", rank).where("rank = 1")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("repeats")))).select("row.*")
