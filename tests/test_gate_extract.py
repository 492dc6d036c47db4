"""G1-G8 borders and X0-X24 on hand-written texts."""
from wattline.operators.extract import extract_fields
from wattline.operators.gate import assemble_text, gate_features, gate_reason, text_gate

ANCH = "TARIFA CUENTA "


def gate(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    return [r.gate_reason for r in text_gate(df).orderBy("id").collect()]


def test_gate_borders(spark):
    base = ANCH + "x" * 80
    out = gate(spark, [
        None, "a" * 79, "a" * 80 + " " + ANCH,
        ANCH + "(cid:1)" * 49 + "a" * 80, ANCH + "(cid:1)" * 50,
        "IBERDROLA " + "a" * 80, "IBERDROLA categoria tarifa " + "a" * 80,
        "TARIFA " + "b" * 80, base,
        ANCH + "a" * 100 + "|" * 40, ANCH + "a" * 100 + "|" * 41,
        ANCH + "1" * 80,
    ])
    assert out[0] == "none_text"
    assert out[1] == "too_short<80"
    assert out[2] == "ok"
    assert out[3] == "ok" and out[4] == "cid_garbage(50)"
    assert out[5] == "iberdrola_missing_anchors" and out[6] == "ok_iberdrola"
    assert out[7] == "missing_strong_anchors(1)" and out[8] == "ok"
    # 112 letters: 40 odd symbols = 0.357 > 0.35; 39 would be 0.348
    assert out[9] == "weird_ratio>0.36" and out[10] == "weird_ratio>0.37"
    assert out[11] == "ok"  # letters > 0 only through anchors; digits are fine


BILL = """CFE SUMINISTRADOR DE SERVICIOS BASICOS
CLIENTE 7 TOTAL A PAGAR:
$1,234.50
NO. DE SERVICIO: 000 111 222 333
CUENTA: 12-AB00000007
RPU: ABC000000007
Periodo facturado: 20 JUN 25 - 20 AGO 25
TARIFA: GDMTONO
MEDIDOR: M7 NO HILOS: 3
Energía (kWh) 5,100 5,000 100
Total 1,234.50
CONSUMO HISTÓRICO
del 20 JUN 25 al 20 AGO 25 2,556 $12,368.00 $0.00
del 21 AGO 25 al
20 SEP 25 10 $1.00 $2.00
Este documento
del 01 ENE 25 al 02 ENE 25 1 $1 $1"""


def test_extract_fields_bill(spark):
    df = spark.createDataFrame([(BILL,)], "text string")
    r = extract_fields(df).collect()[0]
    assert (r.source_utility, r.document_type) == ("CFE", "cfe_bill")
    assert r.cliente_nombre == "CLIENTE 7" and r.importe_total == "1234.50"
    assert r.no_servicio == "000111222333" and r.cuenta == "12AB00000007"
    assert r.rpu == "ABC000000007" and r.tarifa == "GDMTO"
    assert r.medidor == "M7NOHILOS" and r.no_hilos == "3"   # swallowed label, on purpose
    assert (r.periodo_inicio, r.periodo_fin) == ("2025-06-20", "2025-08-20")
    assert (r.lectura_actual_kwh, r.lectura_anterior_kwh, r.kwh_total) == ("5100", "5000", "100")
    assert r.total_linea == "1234.50"
    # a row split over two lines still matches; rows after the footer do not
    assert r.historico_count == 2 and r.tiene_consumo_historico


def test_history_footers_and_fallbacks(spark):
    texts = ["CFE SUMINISTRADOR DE SERVICIOS BASICOS\nsin historia",
             "CSS160330CP7 CONSUMO HISTORICO\n-2-\ndel 1 ENE 25 al 2 ENE 25 1 $1 $1",
             "IBERDROLA Categoría Tarifaria GDMTH Consumo 1,234 kWh"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    rows = extract_fields(df).orderBy("i").collect()
    assert [r.historico_count for r in rows] == [0, 0, 0]
    assert rows[2].tarifa == "GDMTH" and rows[2].kwh_total == "1234"


def test_assemble_text_order_and_limit(spark):
    pages = spark.createDataFrame([("f", 2, "two"), ("f", 1, " one"), ("f", 3, "three"),
                                   ("g", 1, None), ("g", 2, "b ")], "file_path string, page_no int, text string")
    out = {r.file_path: r.text for r in assemble_text(pages, 2).collect()}
    assert out == {"f": "one\ntwo", "g": "b"}
    out = {r.file_path: r.text for r in assemble_text(pages, 2, skip_empty=True).collect()}
    assert out["g"] == "b"


def test_rules_need_few_features(spark):
    """The rules give the same over the needed features as over all; a text in order is upper-cased and counted by neither."""
    pad = "x" * 80
    texts = [None, "", " ", pad, ANCH + pad, "tarifa cuenta " + pad, "TARIFA cuenta " + pad, "tarifa No.  de\nservicio " + pad,
             ANCH + "iBeRdRoLa " + pad, ANCH + "ıberdrola " + pad, "tarﬁfa rpu " + pad, ANCH + "IBERDROLA Categoría Tarif " + pad,
             ANCH + "iberdrola división tarifaria " + pad, " " + ANCH + "|" * 400 + " ", "TARIFA CUENTA " + "1" * 80 + "|",
             ANCH + "ñ中" * 50 + "|" * 60, ANCH + "cid:٣" * 50 + pad, ANCH + "cid:x" * 60, "TARIFA CUENTA RPU NO DE SERVICIO " + pad]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    whole = df.select("id", *gate_features("text")).select("id", gate_reason(80).alias("reason"))
    assert [r.reason for r in whole.orderBy("id").collect()] == gate(spark, texts)
    plan = text_gate(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("upper(") == 1 and plan.count("trim(text") == 1
    lengths = {r.id: r.embedded_text_len for r in text_gate(df, lengths=True).collect()}
    assert lengths == {i: None if t is None else len(t.strip()) for i, t in enumerate(texts)}
