"""A hot key holding a third of all rows: rollups stay whole and exact."""
from pyspark.sql import functions as F

from wattline.operators.fingerprints import mall_rollup, tenant_fingerprints
from wattline.operators.history import history_features
from wattline.plans.queries import _bills, _parsed
from wattline.plans.parse import bill_history

SF = "/root/testdata/sf0.001"


def test_hot_mall_rollup_is_whole(spark):
    b = _bills(spark, SF)
    key = F.regexp_extract("file_name", r"^(\d+)", 1).cast("long")
    hot = b.withColumn("mall_folder", F.when(key % 3 == 0, F.lit("HOT"))
                       .otherwise(F.col("mall_folder")))
    got = mall_rollup(hot.repartition(7)).toPandas()
    want = {}
    for r in hot.select("mall_folder", "recibos_subgroup", "medidor", "kwh_total").collect():
        group = want.setdefault((r[0], r[1]), {"kwh": [], "meters": set()})
        if r[3] is not None:
            group["kwh"].append(float(r[3]))
        if r[2] is not None:
            group["meters"].add(r[2])
    assert len(got) == len(want)
    for r in got.astype(object).where(got.notna(), None).to_dict("records"):
        group = want[r["mall_folder"], r["recibos_subgroup"]]
        assert (r["bills"], r["meters"]) == (len(group["kwh"]), len(group["meters"]))
        assert abs(r["kwh_sum"] - sum(group["kwh"])) < 1e-6
    hot_bills = sum(len(g["kwh"]) for k, g in want.items() if k[0] == "HOT")
    t = tenant_fingerprints(hot).where("mall_folder = 'HOT'")
    assert t.agg(F.sum("bills_count")).first()[0] == hot_bills


def test_hot_file_history_flags(spark):
    h = bill_history(_parsed(spark, SF))
    # one file receives a third of all history rows (copies under 2 contracts)
    n = h.count()
    one = h.limit(1).select("file_path").first()[0]
    extra = h.limit(n // 3).withColumn("file_path", F.lit(one)) \
        .withColumn("no_servicio", F.concat(F.lit("9"), F.col("no_servicio")))
    v2 = history_features(h.unionByName(extra))
    assert v2.count() == n + n // 3
    flagged = v2.where("flag_pdf_mixed_no_servicio").select("file_path").distinct().collect()
    assert [r[0] for r in flagged] == [one]
