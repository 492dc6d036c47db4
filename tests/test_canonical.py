"""Canonical record: exact values, failures reported, metrics rounded half-even."""
from decimal import ROUND_HALF_EVEN, Decimal

import pytest
from pyspark.sql import functions as F

from wattline.functions.numeric import safe_numeric
from wattline.operators.canonical import canonical_bill, derived_metrics
from wattline.operators.gate import assemble_text, gate_features, gate_reason, keyless_pages

COLUMNS = ["kwh_total", "kw_max_demand", "dias_facturados", "importe_total", "cargo_demanda", "tarifa"]


def one(spark, **values):
    row = tuple(values.get(c) for c in COLUMNS)
    df = spark.createDataFrame([row], ", ".join(f"{c} string" for c in COLUMNS))
    return derived_metrics(canonical_bill(df)).first()


@pytest.mark.parametrize("text", ["0.0000004", "0.12345678", "1234567890123.00", "5", "1e3", "-2.50"])
def test_values_survive_exactly(spark, text):
    r = one(spark, kwh_total=text)
    assert r.bill.energy.kwh_total == Decimal(text) and r.bill.provenance.parse_status == "ok"


@pytest.mark.parametrize("text", ["0.123456789", "1e-12", "1234567890123456789", "abc", "1,000"])
def test_values_that_do_not_fit_are_reported(spark, text):
    r = one(spark, kwh_total=text, importe_total="5")
    assert r.bill.energy.kwh_total is None and r.bill.provenance.parse_status == "error"
    assert "kwh_total" in r.bill.provenance.parse_error and r.bill.charges.importe_total == 5


def q(x):
    return x.quantize(Decimal("0.0001"), ROUND_HALF_EVEN)


@pytest.mark.parametrize("kwh,kw,days,total,demand", [
    ("345", "2.5", "30", "800.10", "100"), ("1", "3", "7", "3", "2"), ("0.00005", "1", "1", "1", "0.00015"),
    ("0.00025", "0.5", "2", "8", "-0.0002"), ("-7", "0.3", "31", "-0.03", "5"), ("123456789.12345678", "0.00000001", "62", "0.07", "1"),
])
def test_metrics_against_decimals(spark, kwh, kw, days, total, demand):
    r = one(spark, kwh_total=kwh, kw_max_demand=kw, dias_facturados=days, importe_total=total, cargo_demanda=demand)
    k, w, d, t, c = map(Decimal, (kwh, kw, days, total, demand))
    assert (r.kwh_per_day, r.cost_per_kwh, r.load_factor, r.demand_ratio) == (q(k / d), q(t / k), q(k / (w * 24 * d)), q(c / t))


def test_zero_and_missing_sides(spark):
    r = one(spark, kwh_total="0", kw_max_demand="0", dias_facturados="0", importe_total="0", cargo_demanda="1")
    assert (r.kwh_per_day, r.cost_per_kwh, r.load_factor, r.demand_ratio) == (None,) * 4
    r = one(spark, tarifa="DB1")
    assert r.bill.ids.tarifa == "UNKNOWN" and r.kwh_per_day is None


def test_extreme_values_never_fail_the_job(spark):
    r = one(spark, kwh_total="0.00000001", importe_total="999999999999999999", dias_facturados="2147483647", kw_max_demand="999999999999999999")
    assert r.cost_per_kwh is None or r.cost_per_kwh > 0
    assert r.load_factor == 0
    df = spark.createDataFrame([("1e999",), ("inf",), ("1d",), (" 5 ",)], "v string")
    assert [x[0] for x in df.select(safe_numeric("v")).collect()] == [None, None, None, 5.0]


def test_gate_label_rounds_like_the_binary_value(spark):
    cases = [(77, 200), (75, 200), (71, 200), (79, 200), (83, 200), (125, 200), (91, 200), (1, 2), (2, 3), (87, 200), (36, 100)]
    df = spark.createDataFrame([(w, n, "TARIFA CUENTA " + "a" * (n - 12) + "|" * w + "." * 80) for w, n in cases],
                               "w int, n int, t string").where("n > 20")
    rows = df.select("w", "n", *gate_features("t")).select("w", "n", gate_reason().alias("r")).collect()
    assert {(r.w, r.n): r.r for r in rows} == {
        (w, n): f"weird_ratio>{w / n:.2f}" for w, n in cases if n > 20}


def test_pages_without_key_and_repeated_pages(spark):
    pages = spark.createDataFrame([(None, 1, "x"), (None, 1, "x"), ("a", 1, "one"), ("a", 1, "one"), ("a", 2, None), ("b", 2, "two"),
                                   ("a", 3, "no")], "file_path string, page_no int, text string")
    got = {r.file_path: r.text for r in assemble_text(pages).collect()}
    assert got == {"a": "one", "b": "two"}
    assert keyless_pages(pages).first()[0] == 2
