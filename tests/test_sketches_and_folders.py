"""Sketches united over runs against exact results; bill folders listed by executors; sessions and code generation."""
import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from wattline import session
from wattline.operators.paths import bill_listing
from wattline.plans import sketch_state
from wattline.sources.bill_folders import folder_listing

SF = "/root/testdata/sf0.001"


def test_sketches_unite(spark):
    bills = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("m"), (F.col("id") % 40).cast("string"))).alias("mall_folder"),
        F.concat(F.lit("M"), F.pmod(F.xxhash64("id"), F.lit(20_000)).cast("string")).alias("medidor"),
        F.when(F.col("id") % 11 == 0, "none").otherwise((F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100_000)) / 7).cast("string")).alias("kwh_total"),
        F.lit(None).cast("string").alias("importe_total"))
    keys = ["mall_folder"]
    # Three runs' states, united, against one table.
    states = [sketch_state.sketches(bills.where(F.pmod(F.xxhash64("medidor"), F.lit(3)) == i), keys) for i in range(3)]
    union = sketch_state.united(states[0].unionByName(states[1]).unionByName(states[2]), keys)
    rows = {r["mall_folder"]: r for r in sketch_state.estimates(union, keys).collect()}
    exact = bills.toPandas()
    exact["kwh"] = exact["kwh_total"].where(exact["kwh_total"] != "none").astype(float)
    assert set(rows) == set(exact["mall_folder"])
    for mall, own in exact.groupby("mall_folder"):
        r, values = rows[mall], np.sort(own["kwh"].dropna())
        assert r["bills"] == len(own) and abs(r["meters"] - own["medidor"].nunique()) <= 0.03 * own["medidor"].nunique()
        for p in (25, 50, 75):
            rank = np.searchsorted(values, r[f"kwh_p{p}"], "right") / len(values)
            assert abs(rank - p / 100) < 0.02 + 1 / len(values)
        assert r["importe_p50"] is None


def test_sketches_of_runs_read_only_new_bills(spark, scratch):
    made = spark.createDataFrame([("a", "M1", "10", "1"), ("a", "M2", "20", "2"), (None, None, None, None)],
                                 "mall_folder string, medidor string, kwh_total string, importe_total string")
    for run in ("1-a", "2-a"):
        made.withColumn("file_path", F.concat(F.lit(run), "medidor")).write.parquet(f"{scratch}/bills/run={run}")
        spark.createDataFrame([(run, "ok")], "file_path string, status string").write.json(f"{scratch}/progress/run={run}")
        got = {r["mall_folder"]: r for r in sketch_state.estimates(sketch_state.sketch_runs(spark, scratch, ["mall_folder"]), ["mall_folder"]).collect()}
    assert got["a"]["bills"] == 4 and got["a"]["meters"] == 2 and got["a"]["kwh_p50"] in (10.0, 20.0)
    assert got[None]["meters"] == 0 and got[None]["kwh_p50"] is None
    assert sorted(os.listdir(f"{scratch}/sketches/mall_folder")) == ["run-1-a", "run-2-a"]
    with pytest.raises(FileNotFoundError):
        sketch_state.sketch_runs(spark, f"{scratch}/none", [])


FILES = ["Mall A/7. Recibos CFE/Sub/2024/1.pdf", "Mall A/7. Recibos CFE/2.PDF", "Mall A/Otros/3.pdf", "Mall B/7. Recibos CFE/x/4.txt",
         "Mall B/7. Recibos CFE/x/5.pdf", "Mall B/7. Recibos CFE/_hidden/6.pdf", "7. Recibos CFE/7.pdf", "top.pdf", "Mall C/deep/7. Recibos CFE/8.pdf"]


def _put(root, name):
    os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
    with open(f"{root}/{name}", "w") as f:
        f.write("x")


def test_folders_equal_the_listing(spark, scratch):
    root = f"{scratch}/bills"
    for name in FILES:
        _put(root, name)
    for at in (root, f"{root}/Mall A/7. Recibos CFE"):
        want = {r["file_path"] for r in bill_listing(spark, at).collect()}
        got = [r["file_path"] for r in folder_listing(spark, at).collect()]
        assert set(got) == want and len(got) == len(want) > 0
    # A task for each mall with a bill folder, and one for the root's own.
    assert folder_listing(spark, root).rdd.getNumPartitions() == 3
    os.makedirs(f"{scratch}/empty")
    assert folder_listing(spark, f"{scratch}/empty").count() == 0


def test_arriving_files_are_listed_once(spark, scratch):
    root = f"{scratch}/bills"

    def run():
        q = folder_listing(spark, root, stream=True, settle=0).writeStream.format("parquet").option("path", f"{scratch}/out") \
            .option("checkpointLocation", f"{scratch}/checkpoint").trigger(once=True).start()
        q.awaitTermination()
        return sorted(r["file_path"].removeprefix(f"{root}/") for r in spark.read.schema("file_path string").parquet(f"{scratch}/out").collect())
    _put(root, FILES[0])
    _put(root, FILES[2])
    assert run() == [FILES[0]]
    time.sleep(0.05)
    _put(root, FILES[4])
    assert run() == sorted([FILES[0], FILES[4]])
    assert run() == sorted([FILES[0], FILES[4]])


def test_no_machine_local_folder_on_a_cluster(monkeypatch):
    class Fake:
        class conf:
            @staticmethod
            def get(key, default=None):
                return {"spark.master": "spark://somewhere:7077"}.get(key, default)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Fake())


@pytest.mark.parametrize("name", ["mall_fingerprints", "bill_history"])
def test_every_stage_is_generated(spark, name):
    before = spark.conf.get("spark.sql.codegen.fallback")
    spark.conf.set("spark.sql.codegen.fallback", "false")  # a stage that doesn't compile is an error
    try:
        assert len(E.queries()[name](spark, SF).collect()) > 0
    finally:
        spark.conf.set("spark.sql.codegen.fallback", before)
