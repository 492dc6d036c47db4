"""A5, A8, A9 as sketches: distinct meters and quantiles from states that are stored by run and united.

An opt-in form for tables too large for exact counts: a run's state has a
HyperLogLog sketch of its meters and KLL sketches of its numbers for each key,
a few kilobytes whatever the run's size, and states are united without reading
a bill again. Sketches can't forget: bills that a later run has replaced stay
counted until the runs are compacted, when the base's state is made anew. The
exact forms are ``plans.rollup_state``.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.functions.numeric import safe_numeric
from wattline.plans.incremental import Runs, write_table
from wattline.plans.manifest import Folder

#: Base-2 logarithm of a HyperLogLog sketch's buckets (standard error 0.8 %), and the size of a KLL sketch
#: (normalised rank error about 0.7 %).
BUCKETS_LOG2, RANKS = 14, 400
NUMBERS = {"kwh": "kwh_total", "importe": "importe_total"}


def sketches(bills: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One state per key: ``meters``, ``kwh`` and ``importe`` (sketches) and ``bills``."""
    typed = bills.select(*keys, F.col("medidor").cast("string").alias("medidor"), *[safe_numeric(c).alias(n) for n, c in NUMBERS.items()])
    return typed.groupBy(*keys).agg(F.count(F.lit(1)).alias("bills"), F.hll_sketch_agg("medidor", BUCKETS_LOG2).alias("meters"),
                                    *[F.kll_sketch_agg_double(n, RANKS).alias(n) for n in NUMBERS])


def united(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One state per key from several."""
    return states.groupBy(*keys).agg(F.sum("bills").alias("bills"), F.hll_union_agg("meters").alias("meters"),
                                     *[F.kll_merge_agg_double(n, RANKS).alias(n) for n in NUMBERS])


def estimates(states: DataFrame, keys: Sequence[str], ranks: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Estimated distinct meters and quantiles (``<number>_p<rank in percent>``) of united states; null without values."""
    def quantile(name: str, rank: float) -> Column:
        some = F.kll_sketch_get_n_double(name) > 0
        return F.when(some, F.kll_sketch_get_quantile_double(F.col(name), F.lit(rank))).alias(f"{name}_p{round(100 * rank)}")
    return states.select(*keys, "bills", F.hll_sketch_estimate("meters").alias("meters"),
                         *[quantile(n, r) for n in NUMBERS for r in ranks])


def sketch_runs(spark: SparkSession, out_dir: str, keys: Sequence[str]) -> DataFrame:
    """The united state of everything committed; states that are there already are read, only new runs' bills are."""
    runs, name = Runs(spark, out_dir), "sketches/" + "-".join(keys or ["all"])
    there = set(Folder(spark, out_dir).names(name))
    parts = {f"run-{r}": lambda r=r: runs.table("bills", [r]) for r in runs.names}
    if runs.base is not None:
        parts[f"base-{runs.base}"] = lambda: runs.base_table("bills")
    if not parts:
        raise FileNotFoundError(f"no committed run in {out_dir}")
    for part, bills in parts.items():
        if part not in there:
            write_table(sketches(bills(), keys), f"{out_dir}/{name}/{part}")
    return united(spark.read.parquet(*[f"{out_dir}/{name}/{part}" for part in parts]), keys)
