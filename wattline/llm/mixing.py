"""Operator 1: mixing sources to target weights by subset-sum budget fitting.

Sizes are words. Sources, in code-point order with null last, take the weights
in turn; they share ``budget`` times all words, and a source stops at
``MAX_REPEATS`` times its own words, its excess going to the others by weight.
Within a source, whole passes take every document; the rest of the target is
fitted exactly over the histogram of document lengths: an error-carrying
proportional share of each length first, then a bounded-knapsack (subset-sum)
dynamic programme over the lengths that remain. The documents of a length are
then picked by seeded hash order.

What is gathered: one histogram row per (source, length), in one group per
source; a group grows with the number of different lengths, not with rows.
Documents are ranked within (source, length) through seeded buckets, so one
length that holds a third of all rows is ranked by many tasks.

Nulls: a null text has size 0; a null source is a source like any other. Sizes
of 0 take 0 words whatever is picked. Rows that repeat a doc_id count as
separate documents. An empty table gives an empty result.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import bucket_offsets, row_mark, stored, text_or_empty, unit_hash

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MAX_REPEATS = 2
#: Rows of one (source, length) that are ranked together, on average.
ROWS_PER_BUCKET = 500
#: Mean documents whose words the dynamic programme fits; the rest is shared by length first.
FITTED_DOCS = 32
#: A document's words are the runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def subset_sum(lengths: np.ndarray, free: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their words come nearest to ``budget`` from below.

    Bounded-knapsack dynamic programming: each (length, free) splits into
    powers of two; a Python integer's bits hold the sums in reach after each
    part. It stops at the first part that reaches the budget itself.
    """
    take = np.zeros(len(lengths), dtype=np.int64)
    usable = [i for i in range(len(lengths)) if 0 < lengths[i] <= budget and free[i] > 0]
    # Common lengths first: they fill the table fastest.
    usable.sort(key=lambda i: (-int(free[i]), int(lengths[i])))
    mask, reach, parts = (1 << (budget + 1)) - 1, 1, []
    for i in usable:
        left, length, chunk = min(int(free[i]), budget // int(lengths[i])), int(lengths[i]), 1
        while left > 0 and not reach >> budget & 1:
            count = min(chunk, left)
            parts.append((i, count, reach))
            reach |= (reach << (count * length)) & mask
            left, chunk = left - count, chunk * 2
        if reach >> budget & 1:
            break
    at = reach.bit_length() - 1
    for i, count, before in reversed(parts):
        if not before >> at & 1:
            at -= count * int(lengths[i])
            take[i] += count
    return take


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Documents to take of each length: proportional shares, then ``subset_sum`` for what they leave."""
    take = np.zeros(len(lengths), dtype=np.int64)
    total = int((lengths * counts).sum())
    if budget <= 0 or total <= 0:
        return take
    if budget >= total:
        return counts.copy()
    # Some mean documents' worth of the budget is left to the exact fit.
    shared = max(0, budget - FITTED_DOCS * (total // int(counts.sum()) + 1))
    owed = 0.0
    for i in np.argsort(lengths, kind="stable"):
        length, count = int(lengths[i]), int(counts[i])
        if length:
            owed += shared * (length * count / total)
            take[i] = min(count, int(owed // length))
            owed -= float(take[i]) * length
    rest = budget - int((take * lengths).sum())
    while rest < 0:  # rounding of the carried error; at most a few documents
        i = max((j for j in range(len(lengths)) if take[j]), key=lambda j: int(lengths[j]))
        take[i] -= 1
        rest += int(lengths[i])
    return take + subset_sum(lengths, counts - take, rest)


def _plan(source: pd.DataFrame) -> pd.DataFrame:
    """The plan of one source: whole passes and extra documents for each length."""
    source = source.sort_values("size", kind="stable")
    lengths, counts = source["size"].to_numpy(np.int64), source["docs"].to_numpy(np.int64)
    total, target = int(source["source_size"].iloc[0]), float(source["target"].iloc[0])
    passes = min(MAX_REPEATS, int(target // total)) if total else 0
    extra = fit_budget(lengths, counts, int(round(target - passes * total))) if passes < MAX_REPEATS \
        else np.zeros(len(lengths), np.int64)
    return source.assign(passes=passes, extra=extra)


def numbered(rows: DataFrame, key: str, out: str) -> DataFrame:
    """``rows`` (one a key) with ``out``: the key's place from 0, null last, by a range-partitioned sort.

    Only the row counts of the partitions meet in one task.
    """
    order = F.col(key).asc_nulls_last()
    at = F.monotonically_increasing_id()
    placed = rows.repartitionByRange(order).sortWithinPartitions(order).withColumn("__at", at)
    placed = stored(placed.withColumn("__part", F.shiftright("__at", 33)), "numbered")
    before = bucket_offsets(placed.groupBy("__part").agg(F.count("*").alias("__n")), [], "__part", "__n", "__before")
    within = F.col("__at") - F.shiftleft("__part", 33)
    return placed.join(before.drop("__n"), "__part").withColumn(out, F.col("__before") + within).drop("__part", "__at", "__before")


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET) -> DataFrame:
    """(source, source_size, target): shares by weight, stopped at MAX_REPEATS times a source's size.

    Capping and resharing repeat until no target is above its cap; each round
    is one aggregate over the table of sources, of which two sums are read.
    """
    sources = numbered(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "source", "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = stored(sources.select("source", "source_size", weight.alias("weight"),
                                    (F.col("source_size") * float(MAX_REPEATS)).alias("cap")), "sources")
    whole = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    words, rate, done = budget * float(whole[0] or 0), 0.0, -1
    rate = words / whole[1] if whole[1] else 0.0
    while True:
        over = F.col("weight") * F.lit(rate) >= F.col("cap")
        capped = sources.agg(F.sum(F.when(over, F.col("cap"))), F.sum(F.when(~over, F.col("weight"))),
                             F.count(F.when(over, 1))).first()
        if capped[2] == done or not capped[1]:
            break
        done, rate = capped[2], max(rate, (words - (capped[0] or 0.0)) / capped[1])
    return sources.select("source", "source_size",
                          F.least(F.col("cap"), F.col("weight") * F.lit(rate)).alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, seed: int = 1, key: str = "doc_id",
        text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target, taken, repeats, mark."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), row_mark(key, text).alias("mark"),
                       F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long").alias("size"))
    rows = stored(rows.withColumn("u", unit_hash(seed, "doc_id", "size")), "sizes")
    lengths = stored(rows.groupBy("source", "size").agg(F.count("*").alias("docs")), "lengths")
    targets = source_targets(lengths.select("source", (F.col("size") * F.col("docs")).alias("size")), weights, budget)
    same_source = F.col("source").eqNullSafe(F.col("t_source"))
    hist = lengths.join(targets.withColumnRenamed("source", "t_source"), same_source).drop("t_source")
    plan = stored(hist.groupBy("source").applyInPandas(
        _plan, "source string, size long, docs long, source_size long, target double, passes int, extra long"), "plan")
    return _pick(rows, plan)


def _pick(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Join the plan to the documents and let seeded order pick the extra ones of each length."""
    planned = plan.select(F.col("source").alias("p_source"), F.col("size").alias("p_size"), "docs", "source_size",
                          "target", "passes", "extra")
    rows = rows.join(planned, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size"))) \
        .drop("p_source", "p_size")
    n_buckets = F.ceil(F.col("docs") / F.lit(ROWS_PER_BUCKET))
    rows = rows.withColumn("bucket", F.floor(F.col("u") * n_buckets))
    group = ["source", "size"]
    big = rows.where(F.col("docs") > ROWS_PER_BUCKET).groupBy(*group, "bucket").agg(F.count("*").alias("n"))
    before = bucket_offsets(big, group, "bucket", "n", "before").select(
        F.col("source").alias("b_source"), F.col("size").alias("b_size"), F.col("bucket").alias("b_bucket"), "before")
    rank = F.row_number().over(Window.partitionBy(*group, "bucket").orderBy("u", "doc_id", "mark"))
    ranked = rows.withColumn("rank", rank).join(
        before, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("size") == F.col("b_size"))
        & (F.col("bucket") == F.col("b_bucket")), "left")
    picked = F.coalesce("before", F.lit(0)) + F.col("rank") <= F.col("extra")
    repeats = F.col("passes") + picked.cast("int")
    return ranked.select("doc_id", "size", "source_size", "target", (F.col("size") * repeats).alias("taken"),
                         "source", repeats.alias("repeats"), "mark")
