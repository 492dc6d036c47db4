"""Operator 6: line dedup over overlapping three-line windows (native).

Every three consecutive lines of a text (cut at line feeds) are hashed to 128
bits. Windows that occur more than once in the corpus keep their first
occurrence, ordered by (doc_id, row mark, line); each later occurrence covers
its three lines, and the covered lines, merged, are removed.

Skew: windows are counted with map-side aggregation, and the repeated ones are
joined back from a stored table, so adaptive execution can split the tasks of a
very common window. A document's own lines are the only thing ever gathered.

Nulls: a null text has no lines and stays null; a null doc_id orders first. A
text of fewer than ``WINDOW`` lines has no window and stays as it is. Rows that
repeat both doc_id and text are told apart by order: the first is treated as
if alone, and later ones lose all lines when they have a window. An empty
table gives an empty result.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import stored

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _mark(key: str, text: str) -> Column:
    """128 bits that stand for a row: its doc_id and its text."""
    return F.unhex(F.md5(F.concat_ws("\t", F.coalesce(F.col(key).cast("string"), F.lit("null")), F.col(text))))


def windows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, mark, pos, hash) of every window of every text."""
    lines = docs.where(F.col(text).isNotNull()).select(
        F.col(key).alias("doc_id"), _mark(key, text).alias("mark"), _lines(F.col(text)).alias("lines"))
    n = F.size("lines") - (WINDOW - 1)
    lines = lines.where(n > 0).select("doc_id", "mark", *[F.slice("lines", i + 1, n).alias(f"line{i}")
                                                           for i in range(WINDOW)])
    zipped = F.arrays_zip(*[f"line{i}" for i in range(WINDOW)])
    each = lines.select("doc_id", "mark", F.posexplode(zipped).alias("pos", "three"))
    three = F.concat_ws("\n", *[F.col(f"three.line{i}") for i in range(WINDOW)])
    return each.select("doc_id", "mark", "pos", F.unhex(F.md5(three)).alias("hash"))


def covered_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(mark, covered): sorted line positions to remove from each document that loses any."""
    found = stored(windows(docs, key, text), "windows")
    place = F.struct("doc_id", "mark", "pos")
    repeated = stored(found.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                      .where(F.col("first") != F.col("last")).select("hash", "first"), "repeated-windows")
    later = found.join(repeated, "hash").where(place != F.col("first"))
    starts = later.groupBy("mark").agg(F.collect_set("pos").alias("starts"))
    lines = F.flatten(F.transform("starts", lambda p: F.sequence(p, p + (WINDOW - 1))))
    return starts.select("mark", F.array_sort(F.array_distinct(lines)).alias("covered"))


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, removed, text.

    ``removed`` lists merged ranges of removed lines (first and last, from 0);
    ``text`` holds the lines that stay.
    """
    covered = stored(covered_lines(docs, key, text), "covered-lines")
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), _mark(key, text).alias("mark"))
    copy = F.row_number().over(Window.partitionBy("mark").orderBy("mark"))
    rows = rows.join(covered, "mark", "left").select("doc_id", "text", "covered", copy.alias("copy"))
    # explode(array(x)) keeps x from being computed again inside the lambda below.
    rows = rows.select("doc_id", "text", "covered", "copy", F.explode(F.array(F.coalesce(
        _lines(F.col("text")), F.array().cast("array<string>")))).alias("lines"))
    places = F.when(F.size("lines") > 0, F.sequence(F.lit(0), F.size("lines") - 1)) \
        .otherwise(F.array().cast("array<int>"))
    gone = F.when((F.col("copy") > 1) & (F.size("lines") >= WINDOW), places) \
        .otherwise(F.coalesce("covered", F.array().cast("array<int>")))
    rows = rows.select("doc_id", "text", "lines", gone.alias("gone"), F.array_except(places, gone).alias("stay"))
    kept = F.array_join(F.transform("stay", lambda i: F.col("lines")[i]), "\n")
    removed = F.arrays_zip(
        F.array_except("gone", F.transform("gone", lambda p: p + 1)).alias("first"),
        F.array_except("gone", F.transform("gone", lambda p: p - 1)).alias("last"))
    return rows.select("doc_id", F.size("lines").alias("n_lines"), F.size("gone").alias("n_removed"),
                       removed.cast("array<struct<first:int,last:int>>").alias("removed"),
                       F.when(F.size("gone") == 0, F.col("text")).otherwise(kept).alias("text"))
