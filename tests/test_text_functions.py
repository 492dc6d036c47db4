"""Column-level cases for C1-C12 (FIXTURES.md §4)."""
from pyspark.sql import functions as F

from wattline.functions.numeric import safe_numeric, to_date_or_null, to_num_series
from wattline.functions.text import (
    alnum_only, detect_document_type, digits_only, find_first, normalize_tarifa, num_clean,
    parse_es_date, pystrip,
)
from wattline.operators.extract import PAT_HIST_ROW, PAT_LIMITE, history_row_groups
from wattline.operators.history import history_features


def one(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_strip_unicode_space(spark):
    assert one(spark, ["  a b \r\n", "\t", None], pystrip) == ["a b", "", None]


def test_find_first_accents_and_case(spark):
    out = one(spark, ["límite de pago: 07 nov 25", "LÍMITE DE PAGO:  7 NOV 2025 x", "nada"],
              lambda c: find_first(c, PAT_LIMITE))
    assert out == ["07 nov 25", "7 NOV 2025", None]


def test_digits_alnum_num_clean(spark):
    assert one(spark, ["000 123-4", "--", None], digits_only) == ["0001234", None, None]
    assert one(spark, ["12-ab 99", "ñ-", None], alnum_only) == ["12AB99", None, None]
    assert one(spark, ["$ 1,234.50", "12.", "$ ,", None], num_clean) == \
        ["1234.50", "12.", None, None]


def test_normalize_tarifa(spark):
    assert one(spark, ["PDBTNO", "gdmth no", "DB1", "  ", None, "GDMTONO"], normalize_tarifa) == \
        ["PDBT", "GDMTH", "DB1", None, None, "GDMTO"]


def test_parse_es_date(spark):
    vals = ["7 nov 25", "07 NOV 2025", "07 XXX 25", "07 NOV 125", "07 NOV 25 extra", "31 FEB 25"]
    assert one(spark, vals, parse_es_date) == \
        ["2025-11-07", "2025-11-07", None, "0125-11-07", "2025-11-07", "2025-02-31"]
    assert one(spark, vals, lambda c: parse_es_date(c, whole=True)) == \
        ["2025-11-07", "2025-11-07", None, "0125-11-07", None, "2025-02-31"]


def test_dates_and_numbers(spark):
    assert [str(d) if d else None for d in one(spark, ["2025-02-31", "2025-02-28", "0125-01-01"],
                                                to_date_or_null)] == [None, "2025-02-28", None]
    assert one(spark, ["None", "nan", "1d", "1f", "1e5", " 12 ", "1_000", "1.2.3", "$1,000"],
               to_num_series) == [None, None, None, None, 1e5, 12.0, None, None, 1000.0]
    assert one(spark, ["inf", "-3.5", ""], safe_numeric) == [None, -3.5, None]


def test_detect_document_type(spark):
    rows = one(spark, ["x IBERDROLA y CFE SUMINISTRADOR DE SERVICIOS BASICOS",
                       "rfc: cfe123456", "CSS160330CP7", "Comision Federal de Electricidad",
                       "nothing", None], detect_document_type)
    assert [(r.source_utility, r.document_type) for r in rows] == [
        ("IBERDROLA", "iberdrola_cfdi"), ("CFE", "cfe_bill"), ("CFE", "cfe_bill"),
        ("CFE", "cfe_bill"), ("UNKNOWN", "unknown"), ("UNKNOWN", "unknown")]


def test_history_numbers_are_read_few_times(spark):
    """the numbers of a history row are stripped in projections of their own, with the values of ``to_num_series``."""
    texts = ["1,234.50", " $ 12 ", "\u2003$\t7\u00a0", "nan", "None", "", None, "1e999", "-1e999", "-0", "12.", "0x1", "7\u00a0kWh"]
    rows = spark.createDataFrame([(str(i), t, t, t) for i, t in enumerate(texts)], "file_path string, kwh string, importe string, pagos_pendientes string")
    v2 = history_features(rows.withColumns({c: F.lit("2025-01-01") for c in ("periodo_inicio", "periodo_fin", "no_servicio")}))
    assert v2._jdf.queryExecution().optimizedPlan().toString().count("trim(") <= 4 * 3
    got = {r["file_path"]: (r["kwh"], r["importe"], r["pagos_pendientes"]) for r in v2.collect()}
    assert got == {str(i): (v, v, v) for i, v in enumerate(one(spark, texts, to_num_series))}


def test_history_groups_are_those_of_the_pattern(spark):
    """one run of the pattern gives what five runs give."""
    texts = ["del 01 ENE 25 al 31 ENE 25 1,200 $3,400.50 $0.00", "x DEL 1\u00a0ene 2025  al 2 feb 25 7 8 9 y\nz", "no row", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "m string")
    plain = [pystrip(F.regexp_extract("m", PAT_HIST_ROW, i)) for i in range(1, 6)]
    want = rows.select(*plain[:2], *[F.translate(p, "$, ", "") for p in plain[2:]])
    assert history_row_groups(rows, "m", []).collect() == want.collect()


def test_strip_of_a_named_column(spark):
    texts = ["", " ", "a", "\u00a0a b\u2028", "~", "!x\x1f", "\x7f ", "é", "a\u3000", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in rows.select(pystrip("t")).collect()] == [None if t is None else t.strip() for t in texts]
