import pytest
"""A1-A13 on small hand-made bill tables (missing keys, ties, empty groups)."""
import numpy as np

from wattline.operators.fingerprints import (
    mall_fingerprints, mall_rollup, meter_profile, tariff_pivot, tariff_shares,
    tenant_fingerprints,
)
from wattline.operators.history import history_features
from wattline.operators.profile import dataset_profile, describe, histogram, profile_json, \
    value_counts

SCHEMA = ("mall_folder string, recibos_subgroup string, medidor string, tarifa string, "
          "kwh_total string, importe_total string, periodo_inicio string, periodo_fin string")
ROWS = [
    ("m1", "s1", "A", "PDBT", "100", "200.00", "2025-01-01", "2025-01-31"),
    ("m1", "s1", "A", "GDBT", "300", "300.00", "2025-02-01", "2025-02-28"),
    ("m1", "s1", "B", None, None, "10.00", "2025-02-31", "2025-03-01"),
    ("m1", None, "C", "PDBT", "0", "50.00", "2025-01-01", "2025-01-02"),
    ("m2", "s2", None, None, None, None, None, None),
]


def bills(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_mall_rollup(spark):
    r = {(x.mall_folder, x.recibos_subgroup): x for x in mall_rollup(bills(spark)).collect()}
    a = r[("m1", "s1")]
    assert (a.bills, a.meters, a.kwh_sum, a.kwh_mean_bill, a.importe_sum) == (2, 2, 400.0, 200.0, 510.0)
    assert a.mxn_per_kwh_mean == (2.0 + 1.0) / 2 and a.kwh_per_meter == 200.0
    b = r[("m2", "s2")]
    assert (b.bills, b.meters, b.kwh_sum, b.kwh_mean_bill, b.kwh_per_meter) == (0, 0, 0.0, None, None)
    assert r[("m1", None)].mxn_per_kwh_mean is None   # kwh 0 -> no price


def test_tariff_shares_and_pivot(spark):
    sh = tariff_shares(bills(spark)).collect()
    s1 = {x.tarifa: x.tarifa_share for x in sh if x.recibos_subgroup == "s1"}
    assert s1 == {"PDBT": 1 / 3, "GDBT": 1 / 3, "nan": 1 / 3}
    assert all(x.tarifa_share is None for x in sh if x.recibos_subgroup is None)
    labels = ["GDBT", "PDBT", "nan"]
    wide = tariff_pivot(bills(spark), labels)
    assert wide.columns == ["mall_folder", "recibos_subgroup", "share_GDBT", "share_PDBT", "share_nan"]
    w = {x.mall_folder: x for x in wide.collect()}
    assert w["m2"].share_nan == 1.0 and w["m2"].share_PDBT == 0.0
    fp = {(x.mall_folder, x.recibos_subgroup): x for x in mall_fingerprints(bills(spark), labels).collect()}
    maps = {(x.mall_folder, x.recibos_subgroup): x.tarifa_shares for x in mall_fingerprints(bills(spark)).collect()}
    assert maps[("m1", "s1")] == s1 and maps[("m1", None)] is None
    with pytest.raises(Exception, match="not in the list: nan"):
        mall_fingerprints(bills(spark), labels[:2]).collect()
    assert fp[("m1", None)].share_PDBT is None and fp[("m1", "s1")].share_GDBT == 1 / 3


def test_tenant_fingerprints(spark):
    t = {(x.mall_folder, x.recibos_subgroup, x.medidor): x
         for x in tenant_fingerprints(bills(spark)).collect()}
    a = t[("m1", "s1", "A")]
    assert a.tarifa_mode == "GDBT"          # tie -> smallest label
    assert (a.bills_count, a.kwh_sum, a.kwh_median) == (2, 400.0, 200.0)
    assert (str(a.first_periodo_inicio), str(a.last_periodo_fin), a.months_span) == \
        ("2025-01-01", "2025-02-28", 1.9)
    b = t[("m1", "s1", "B")]
    assert b.tarifa_mode is None and b.kwh_sum == 0.0 and b.kwh_mean is None
    assert b.first_periodo_inicio is None   # impossible date
    c = t[("m1", None, "C")]
    assert c.first_periodo_inicio is None and c.months_span is None   # missing key


def test_meter_profile_with_kw(spark):
    df = spark.createDataFrame([("A", "100", "2"), ("A", None, "4"), (None, "5", "1")],
                               "m string, kwh string, kw string")
    r = meter_profile(df, "m", "kwh", "kw", hours=10).collect()
    assert len(r) == 1 and r[0].bills == 2 and r[0].avg_kwh == 100.0 and r[0].load_factor == 100 / 30


def test_histogram_matches_numpy(spark):
    vals = [0.0, 1.0, 1.5, 2.0, 7.25, 10.0, 10.0, 3.3333333333, 9.999999]
    df = spark.createDataFrame([(str(v),) for v in vals] + [(None,)], "x string")
    got = [r["count"] for r in histogram(df, "x", 30).orderBy("bin").collect()]
    want, _ = np.histogram(np.array(vals), bins=30)
    assert got == list(want)
    same = spark.createDataFrame([("5",), ("5",)], "x string")
    got = [r["count"] for r in histogram(same, "x", 30).orderBy("bin").collect()]
    assert got == list(np.histogram(np.array([5.0, 5.0]), bins=30)[0])


def test_describe_and_value_counts(spark):
    vals = [1.0, 2.0, 4.0, 8.0, 16.0]
    df = spark.createDataFrame([(str(v),) for v in vals] + [("x",)], "v string")
    d = describe(df, "v").collect()[0]
    assert d["count"] == 5 and abs(d["std"] - np.std(vals, ddof=1)) < 1e-12
    assert (d.p25, d.p50, d.p75) == tuple(np.percentile(vals, [25, 50, 75]))
    vc = value_counts(bills(spark), "tarifa").collect()
    assert [(r.tarifa, r["count"]) for r in vc] == [("PDBT", 2), ("nan", 2), ("GDBT", 1)]


def test_profile_json(spark):
    p = dataset_profile(bills(spark).withColumnRenamed("kwh_total", "kwh"))
    js = profile_json(p).collect()[0].value
    assert '"rows":5' in js and '"unique_meters":3' in js and '"kwh_desc"' in js


def test_history_features_flags(spark):
    h = spark.createDataFrame([
        ("f1", "1", "c", "2025-01-01", "2025-01-30", "300", "$1,000.00"),
        ("f1", "2", "c", "2025-02-01", "2025-01-01", "0", "5"),
        ("f2", "1", None, "2025-02-31", "2025-03-01", None, "5"),
        (None, "1", "c", "2025-01-01", "2025-01-01", "10", "5"),
    ], "file_path string, no_servicio string, cuenta string, periodo_inicio string, "
       "periodo_fin string, kwh string, importe string")
    r = {(x.file_path, x.no_servicio): x for x in history_features(h).collect()}
    a = r[("f1", "1")]
    assert a.billing_days == 30 and a.kwh_por_dia == 10.0 and a.costo_por_kwh == 1000 / 300
    assert a.flag_pdf_mixed_no_servicio and not a.flag_pdf_mixed_cuenta
    b = r[("f1", "2")]
    assert b.billing_days is None and b.flag_bad_days and b.costo_por_kwh is None
    c = r[("f2", "1")]
    assert c.period_key == "NaT__2025-03-01" and c.flag_missing_dates and c.flag_missing_kwh
    assert c.pdf_cuenta_nunique == 0 and not c.flag_pdf_mixed_cuenta
    d = r[(None, "1")]
    assert d.pdf_no_servicio_nunique is None and not d.flag_pdf_mixed_no_servicio
    assert d.billing_days == 1


def test_many_labels_stay_on_executors(spark):
    """50,000 free-text labels: no job while the plan is built, one read, whole shares."""
    df = spark.range(50_000).selectExpr(
        "'m' AS mall_folder", "concat('s', id % 3) AS recibos_subgroup", "concat('M', id % 100) AS medidor",
        "'5' AS kwh_total", "'10' AS importe_total", "concat('T', id) AS tarifa")
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "plan only")
    fp = mall_fingerprints(df)
    assert not list(status.getJobIdsForGroup("build"))
    spark.sparkContext.setJobGroup("run", "")
    rows = fp.collect()
    assert sum(len(r.tarifa_shares) for r in rows) == 50_000
    assert all(abs(sum(r.tarifa_shares.values()) - 1) < 1e-9 and r.meters == 100 for r in rows)
    plan = fp._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1 and "Join" not in plan


@pytest.mark.parametrize("wide", [50_000, 40])
def test_percentiles_against_numpy(spark, monkeypatch, wide):
    import numpy as np
    from wattline.operators import percentiles as P
    monkeypatch.setattr(P, "WIDE", wide)
    monkeypatch.setattr(P, "CUTS", 7)
    rng = np.random.default_rng(3)
    rows = [("hot" if i % 3 else None, int(i % 2), float(rng.choice([1.5, rng.normal()]))) for i in range(900)] + [("hot", 1, None), ("x", 0, 2.0)]
    df = spark.createDataFrame(rows, "a string, b int, v double").repartition(5)
    probs = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    got = {tuple(r["key"]): r for r in P.percentiles(df, ["a", "b"], "v", probs).collect()}
    for k in {(a, b) for a, b, v in rows}:
        v = [x for a, b, x in rows if (a, b) == k and x is not None]
        for name, p in probs.items():
            assert abs(got[k][name] - np.quantile(v, p)) < 1e-12
    one = P.percentiles(df, [], "v", probs).collect()
    assert len(one) == 1 and abs(one[0]["p50"] - np.median([r[2] for r in rows if r[2] is not None])) < 1e-12
    assert P.percentiles(df.limit(0), ["a"], "v", probs).count() == 0


def test_hot_group_without_meter(spark):
    """A third of all bills has no meter: exact medians and mode of that group."""
    import numpy as np
    rows = [("m", "s", None if i % 3 == 0 else f"M{i % 50}", str(i % 997 + i / 1000), str(i), "A" if i % 4 else "B") for i in range(6000)]
    df = spark.createDataFrame(rows, "mall_folder string, recibos_subgroup string, medidor string, kwh_total string, "
                                     "importe_total string, tarifa string").repartition(6)
    got = [r for r in tenant_fingerprints(df).collect() if r.medidor is None]
    own = [r for r in rows if r[2] is None]
    assert len(got) == 1 and got[0].bills_count == len(own) and got[0].tarifa_mode == "A"
    assert abs(got[0].kwh_median - np.median([float(r[3]) for r in own])) < 1e-9
