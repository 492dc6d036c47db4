"""The steps that every query shares run once: the gate, what a condition on a computed column reads, what is read twice."""
import datetime

from pyspark.sql import functions as F

from wattline.functions.text import es_date_text
from wattline.operators.fingerprints import meter_profile
from wattline.operators.paths import build_index
from wattline.operators.profile import describe, histogram
from wattline.plans.parse import bill_history, parse_bills


def _parsed(spark):
    path = "/bills/A/7. Recibos CFE/B/2024/1.pdf"
    index = build_index(spark.createDataFrame([(path,)], "file_path string"), "/bills")
    pages = spark.createDataFrame([(path, 1, "recibo ilegible")], "file_path string, page_no int, text string")
    text = ("CFE SUMINISTRADOR DE SERVICIOS BASICOS\nTARIFA: PDBT\nCUENTA: 12\nMEDIDOR: M1\n"
            "Energía (kWh) 5,100 5,000 100\nCONSUMO HISTÓRICO\ndel 01 ENE 24 al 31 ENE 24 100 $1.00 $0.00\n")
    alternates = spark.createDataFrame([(path, 1, text), ("/bills/other.pdf", 1, text)], pages.schema)
    return parse_bills(index, pages, alternates)


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_the_gate_runs_once(spark):
    parsed = _parsed(spark)
    assert _plan(parsed.select("file_path", "text_source_reason")).count(r"cid:\d+") == 1
    row = parsed.first()
    assert (row.text_source, row.medidor, row.kwh_total) == ("ocr", "M1", "100")


def test_conditions_on_read_fields_stay_above_the_reading(spark):
    parsed = _parsed(spark)
    plain = _plan(parsed.select("medidor", "kwh_total")).count(r"MEDIDOR\s*:")
    profile = meter_profile(parsed, "medidor", "kwh_total")
    assert _plan(profile).count(r"MEDIDOR\s*:") == plain
    assert [tuple(r) for r in profile.collect()] == [("M1", 100.0, 1)]
    history = bill_history(parsed)
    assert _plan(history).count(r"CONSUMO\s+HIST") == 1
    assert [(r.kwh, r.periodo_inicio) for r in history.collect()] == [("100", "2024-01-01")]


def test_described_values_are_computed_once(spark):
    values = spark.createDataFrame([("1",), ("2",), ("x",), (None,), ("4",)], "v string")
    d = describe(values, "v")
    assert "regexp" not in _plan(d).lower() and "rlike" not in _plan(d).lower()
    assert [d.first()[c] for c in ("count", "min", "p50", "max")] == [3.0, 1.0, 2.0, 4.0]
    h = histogram(values, "v", 3)
    assert "rlike" not in _plan(h).lower()
    assert [r["count"] for r in h.orderBy("bin").collect()] == [1, 1, 1]


def test_date_text_is_that_of_date_format(spark):
    days = [(datetime.date(y, m, d),) for y, m, d in ((1, 1, 1), (999, 12, 31), (1900, 2, 28), (2000, 2, 29), (2026, 9, 8))]
    df = spark.createDataFrame(days, "d date").select("d", es_date_text("d").alias("t"), F.date_format("d", "dd").alias("day"),
                                                      F.date_format("d", "yy").alias("year"))
    for r in df.collect():
        assert (r.t.split(" ")[0], r.t.split(" ")[2]) == (r.day, r.year)
