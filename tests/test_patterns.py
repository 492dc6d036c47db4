"""The layout patterns are linear on runs of blanks and equal to their plain forms."""
import random
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from wattline.functions.text import CI, CIM
from wattline.operators import extract as X

_N = r"([0-9][0-9,\.]*)"
# The plain forms of the patterns that are written possessively.
PLAIN = {
    "PAT_CLIENTE": CIM + r"^\s*([A-ZÁÉÍÓÚÑ0-9\.\-&,/ ]+?)\s+TOTAL\s+A\s+PAGAR\s*:",
    "PAT_KWH_ANY": CI + _N + r"\s*kWh\b",
    "PAT_IMPORTE": CI + r"TOTAL\s+A\s+PAGAR\s*:?\s*[\r\n]*\s*\$?\s*" + _N,
    "PAT_TOTAL_LINEA": CIM + r"^\s*Total\s+" + _N + r"\s*$",
    "PAT_HIST_ROW": r"(?iUd)del\s+(\d{1,2}\s+[A-ZÁÉÍÓÚÑ]{3}\s+\d{2,4})\s+al\s+"
                    r"(\d{1,2}\s+[A-ZÁÉÍÓÚÑ]{3}\s+\d{2,4})\s+"
                    r"([0-9][0-9,\.]*)\s+\$?\s*([0-9][0-9,\.]*)\s+\$?\s*([0-9][0-9,\.]*)",
}
WORDS = ["TOTAL", "A", "PAGAR", "TOTAL A PAGAR", "TOTAL A PAGAR:", ":", "$", "ACME", "Ñandú", "1,2.3", "12", "kWh", "Total",
         "Total 5", "del 01 ENE 24 al 02 FEB 24", "3 4 $5", "x;", "a", "5kWh", "."]
BLANKS = ["", " ", "  ", "\n", " \n", "\n ", "\t", "\r\n", "\n\n", "   ", "\u00a0"]


def test_equal_to_the_plain_forms(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice(WORDS) + rng.choice(BLANKS) for _ in range(rng.randrange(1, 12))) for _ in range(6000)]
    texts += [rng.choice(BLANKS) + rng.choice(BLANKS) + t for t in texts[:2000]]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(8)
    for name, plain in PLAIN.items():
        groups = range(1, 6) if name == "PAT_HIST_ROW" else [1]
        differ = F.lit(False)
        for g in groups:
            differ = differ | (F.trim(F.regexp_extract("t", plain, g)) != F.trim(F.regexp_extract("t", getattr(X, name), g)))
        wrong = df.where(differ).collect()
        assert not wrong, (name, wrong[:3])
        assert df.where(F.regexp_extract("t", plain, 1) != "").count() > 20, name


def _runs(k):
    for run in (" " * k, "\n" * k, " \n" * (k // 2)):
        for head in ("", "ACME ", "ACME\n", "TOTAL", "TOTAL A PAGAR", "TOTAL A PAGAR :", "MEDIDOR :", "RPU:", "CUENTA:", "TARIFA:",
                     "NO. DE SERVICIO:", "Total 5", "Total", "del 01 ENE 24 al 02 FEB 24 3", "del 01 ENE 24 al 02 FEB 24",
                     "Energia (kWh)", "Energia (kWh) 5", "Cargo Fijo", "IVA 16%", "Subtotal", "12", "PERIODO FACTURADO:",
                     "LIMITE DE PAGO:", "CORTE A PARTIR:", "MULTIPLICADOR:", "Fac. del Periodo", "CATEGORIA TARIFARIA"):
            yield head + run + "x"


@pytest.mark.parametrize("name", sorted(n for n in dir(X) if n.startswith("PAT_")))
def test_blank_runs_take_linear_time(spark, name):
    df = spark.createDataFrame([(t,) for t in _runs(10_000)], "t string").repartition(8).cache()
    df.count()
    began = time.time()
    df.select(F.sum(F.length(F.regexp_extract("t", getattr(X, name), 0)))).collect()
    # 81 texts of 10,000 blanks on 8 cores; one cubic text alone would take hours.
    assert time.time() - began < 20, name


LABELS = ["NO. DE SERVICIO:", "no. de servicio :", "CUENTA:", "SUBCUENTA : ", "RMU:", "RPU:", "XRPU:", "LÍMITE DE PAGO:", "limite de pago :",
          "LıMıTE DE PAGO:", "CORTE A PARTIR:", "Periodo facturado:", "TARIFA:", "xTARIFA:", "Categoría Tarifaria", "MEDIDOR:", "MULTIPLICADOR:",
          "NO HILOS:", "no hiloſ:", "Energía (kWh)", "Energia (KWh)", "Energía", "TOTAL A PAGAR:", "Cargo Fijo", "Subtotal", "ſubtotal", "IVA 16%",
          "İVA 16%", "Fac. del Periodo", "Total", "CARGO", "MITE", "IBERDROLA", "CFE SUMINISTRADOR DE SERVICIOS BASICOS", "straße", "ﬁjo"]
VALUES = ["123 456-789", "AB12-3", "ABC 123456", "07 NOV 25", "07 NOV 25 - 09 dic 2025", "PDBT NO", "gdmth", "5,100 5,000 100", "$1,234.50", "3", "x", "é",
          "\U0001f600", "", "kWh", "12 kWh"]


def test_anchored_fields_equal_those_of_the_whole_text(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice(LABELS if k % 2 else VALUES) + rng.choice(BLANKS) for k in range(rng.randrange(1, 30))) for _ in range(5000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, ""])], "id int, text string").repartition(8)
    plain = [replace(spec, anchor=None) for spec in X.DEFAULT_SPECS]
    assert sum(spec.anchor is not None for spec in X.DEFAULT_SPECS) == 19
    got, want = (X.extract_fields(df, specs=specs, evidence=specs is not plain).drop("evidence") for specs in (X.DEFAULT_SPECS, plain))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert all(want.where(F.col(c).isNotNull()).count() > 50 for c in ("no_servicio", "rpu", "limite_pago", "tarifa", "no_hilos", "kwh_total", "iva"))


def test_evidence_is_where_it_says(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice(LABELS if k % 2 else VALUES) + rng.choice(BLANKS) for k in range(rng.randrange(1, 30))) for _ in range(3000)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None, ""])], "id int, text string").repartition(8)
    rows = X.extract_fields(df, evidence=True).join(df, "id").collect()
    names = {name: spec for spec in reversed(X.DEFAULT_SPECS) for name in spec.names}
    pairs = []
    for r in rows:
        found = {name for name in names if r[name] is not None}
        assert found == set(r["evidence"])
        for name in found:
            snippet, offset = r["evidence"][name]
            assert offset >= 1 and r["text"][offset - 1:].startswith(snippet) and snippet == snippet.strip()
            pairs.append((name, snippet, r[name]))
    assert len(pairs) > 3000
    made = spark.createDataFrame(pairs, "name string, snippet string, value string")
    for name, spec in names.items():
        clean = spec.clean or (lambda c: c)
        assert made.where((F.col("name") == name) & ~clean(F.col("snippet")).eqNullSafe(F.col("value"))).count() == 0, name


def test_evidence_matches_from_the_anchors_on(spark):
    """only the patterns without an anchor and the history section divide the whole text; the others begin at their anchors."""
    texts = spark.createDataFrame([("a", "x TARIFA: GDMTH\nMEDIDOR: M1\n")], "file_path string, text string")
    found = X.extract_fields(texts, evidence=True)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    whole = sum(spec.anchor is None for spec in X.DEFAULT_SPECS)
    assert 0 < plan.count("split(_text#") <= whole + 2
    row = found.first()
    assert {k: (v["snippet"], v["offset"]) for k, v in row["evidence"].items()} == {"tarifa": ("GDMTH", 11), "medidor": ("M1", 26)}
