"""DuckDB SQL oracle for the registered queries.

Independent of the Spark side: expected values are computed from the source
columns of ``orders``, ``customer``, ``nation`` and ``lineitem`` by the
rendering rules of FIXTURES.md -- the oracle never parses a bill text. Text
lengths and digests come from an SQL rendering of the same layout.
"""
from __future__ import annotations

# The white space that Python's str.strip removes.
WHITE_SPACE = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
# The columns of the flat bills table, in order.
BILL_COLUMNS = [
    "source_utility", "document_type", "cliente_nombre", "no_servicio", "cuenta", "rmu", "rpu", "limite_pago",
    "corte_a_partir", "periodo_inicio", "periodo_fin", "tarifa", "medidor", "multiplicador", "no_hilos",
    "lectura_actual_kwh", "lectura_anterior_kwh", "kwh_total", "importe_total", "cargo_fijo", "subtotal_energia",
    "subtotal", "iva", "fac_del_periodo", "total_linea", "tiene_consumo_historico", "historico_count", "file_path",
    "file_name", "mall_folder", "recibos_subgroup", "recibos_year_folder", "recibos_year", "parse_status",
    "parse_error", "text_len", "embedded_text_len", "used_ocr", "text_source", "text_source_reason",
    "extracted_pages"]

MONTHS = "['ENE','FEB','MAR','ABR','MAY','JUN','JUL','AGO','SEP','OCT','NOV','DIC']"


def _es(d: str) -> str:
    return f"(strftime({d}, '%d') || ' ' || {MONTHS}[month({d})] || ' ' || strftime({d}, '%y'))"


def _f2(x: str) -> str:
    return f"format('{{:,.2f}}', {x})"


def _f0(x: str) -> str:
    return f"format('{{:,}}', {x})"


SRC = f"""
src AS (
  SELECT o.o_orderkey AS okey, o.o_custkey AS ck, CAST(o.o_orderkey % 100 AS INTEGER) AS cls,
         n.n_name AS mall, c.c_mktsegment AS seg,
         CAST(o.o_orderdate AS DATE) + 9131 AS ini,
         CASE WHEN o.o_orderkey % 97 = 0 THEN CAST(o.o_orderdate AS DATE) + 9131 - 5
              ELSE CAST(o.o_orderdate AS DATE) + 9131 + CAST(o.o_orderkey % 62 AS INTEGER) END AS fin,
         CAST(CASE WHEN o.o_orderkey % 100 = 10 THEN 0 ELSE 100 + o.o_orderkey % 9000 END AS BIGINT) AS kwh,
         o.o_totalprice AS total,
         ['PDBT','GDBT','GDMTO','GDMTH','DB1'][TRY_CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER)] AS tariff
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                JOIN nation n ON c.c_nationkey = n.n_nationkey
),
paths AS (
  SELECT *,
    CASE cls
      WHEN 11 THEN '/bills/' || mall || '/Otros/' || seg || '/' || year(ini) || '/' || okey || '.pdf'
      WHEN 12 THEN '/bills/' || mall || '/7. Recibos CFE/' || seg || '/1985-' || year(ini) || '/' || year(ini) || '/' || okey || '.pdf'
      WHEN 13 THEN '/bills/' || mall || '/7. Recibos CFE/' || okey || '.pdf'
      WHEN 14 THEN '/bills/' || mall || '/7. Recibos CFE/' || seg || '/' || year(ini) || '/' || okey || '.PDF'
      ELSE '/bills/' || mall || '/7. Recibos CFE/' || seg || '/' || year(ini) || '/' || okey || '.pdf'
    END AS file_path,
    CASE WHEN cls = 14 THEN okey || '.PDF' ELSE okey || '.pdf' END AS file_name,
    CASE WHEN cls = 13 THEN NULL ELSE seg END AS sub,
    CASE WHEN cls = 13 THEN NULL ELSE CAST(year(ini) AS VARCHAR) END AS year_folder,
    CASE WHEN cls = 13 THEN NULL ELSE CAST(year(ini) AS BIGINT) END AS year_num
  FROM src
),
lines AS (
  SELECT l_orderkey AS okey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity,
    l_extendedprice, l_returnflag,
    CAST(l_shipdate AS DATE) + 9131 AS hs,
    CASE WHEN l_orderkey % 97 = 0 THEN CAST(l_shipdate AS DATE) + 9131 - 5
         ELSE CAST(l_shipdate AS DATE) + 9131 + CAST(29 + l_linenumber % 3 AS INTEGER) END AS he,
    CAST(floor(l_quantity * 100) AS BIGINT) AS hkwh,
    l_extendedprice AS himp,
    CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0.0 END AS hpag,
    (l_orderkey % 100 = 9 AND l_linenumber = 1) AS bad_start,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_returnflag) - 1 AS idx
  FROM lineitem
),
hlines AS (
  SELECT *,
    CASE WHEN bad_start THEN '31 FEB ' || strftime(hs, '%y') ELSE {_es('hs')} END AS hs_txt,
    {_es('he')} AS he_txt
  FROM lines
),
hist AS (
  SELECT okey AS hokey, count(*) AS n_lines,
    string_agg('del ' || hs_txt || ' al ' || he_txt || ' ' || {_f0('hkwh')} || ' $' || {_f2('himp')}
               || ' $' || {_f2('hpag')}, chr(10) ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_returnflag) AS hist_text
  FROM hlines GROUP BY okey
),
docs AS (
  SELECT p.*, coalesce(h.n_lines, 0) AS n_lines,
    concat_ws(chr(10),
      'CFE SUMINISTRADOR DE SERVICIOS BASICOS',
      'RFC: CSS160330CP7',
      'CLIENTE ' || ck || ' TOTAL A PAGAR:',
      '$' || {_f2('total')},
      'NO. DE SERVICIO: ' || substr(printf('%012d', okey), 1, 3) || ' ' || substr(printf('%012d', okey), 4, 3)
        || ' ' || substr(printf('%012d', okey), 7, 3) || ' ' || substr(printf('%012d', okey), 10, 3),
      'CUENTA: 12-AB' || printf('%08d', ck),
      'RMU: 29010 ' || printf('%07d', ck),
      'RPU: ABC' || printf('%09d', ck),
      'LÍMITE DE PAGO: ' || {_es('fin + 15')},
      'CORTE A PARTIR: ' || {_es('fin + 16')},
      'Periodo facturado: ' || CASE WHEN cls = 9 THEN '31 FEB ' || strftime(ini, '%y') ELSE {_es('ini')} END
        || ' - ' || {_es('fin')},
      CASE WHEN cls <> 7 THEN 'TARIFA: ' || CASE WHEN tariff = 'DB1' THEN tariff ELSE tariff || 'NO' END END,
      CASE WHEN cls = 8 THEN 'MEDIDOR: M' || ck || ' NO HILOS: 3' ELSE 'MEDIDOR: M' || ck END,
      'MULTIPLICADOR: 1',
      CASE WHEN cls <> 8 THEN 'NO HILOS: 3' END,
      'Energía (kWh) ' || {_f0('kwh + 5000')} || ' ' || {_f0('5000')} || ' ' || {_f0('kwh')},
      'Cargo Fijo mensual 70.10',
      'Energía ' || {_f2('total')},
      'Subtotal ' || {_f2('total')},
      'IVA 16% 11.22',
      'Fac. del Periodo ' || {_f2('total')},
      'Total ' || {_f2('total')}) AS page1,
    concat_ws(chr(10), 'CONSUMO HISTÓRICO', h.hist_text,
              'Datos Fiscales', 'del 01 ENE 25 al 02 ENE 25 1 $1 $1') AS page2
  FROM paths p LEFT JOIN hist h ON p.okey = h.hokey
),
texts AS (
  SELECT *,
    page1 || chr(10) || page2 AS clean_text,
    CASE cls
      WHEN 0 THEN 'recibo ilegible'
      WHEN 1 THEN repeat('(cid:12)', 60) || chr(10) || page1 || chr(10) || page2
      WHEN 2 THEN concat_ws(chr(10), 'IBERDROLA CLIENTES, S.A. DE C.V.',
                            'CLIENTE ' || ck || ' TOTAL A PAGAR:', '$' || {_f2('total')},
                            'Categoría Tarifaria GDMTH', 'Consumo ' || {_f0('kwh')} || ' kWh')
      WHEN 3 THEN 'IBERDROLA MEXICO S.A. DE C.V.' || chr(10) || 'AVISO DE COBRO SIN DESGLOSE PARA EL SERVICIO '
                  || okey || chr(10) || 'CONSULTE SU ESTADO DE CUENTA EN LINEA'
      WHEN 4 THEN 'Estimado usuario, le informamos que el documento ' || okey
                  || ' no contiene datos de facturacion legibles en este momento.'
      WHEN 5 THEN 'CFE TARIFA CUENTA MEDIDOR RPU ' || repeat('|', 4000) || ' ' || okey
      WHEN 6 THEN NULL
      ELSE page1 || chr(10) || page2
    END AS emb_text,
    CASE cls WHEN 0 THEN 'too_short<80' WHEN 1 THEN 'cid_garbage(60)' WHEN 2 THEN 'ok_iberdrola'
             WHEN 3 THEN 'iberdrola_missing_anchors' WHEN 4 THEN 'missing_strong_anchors(0)'
             WHEN 5 THEN 'weird_ratio>160.00' WHEN 6 THEN NULL ELSE 'ok' END AS reason,
    cls IN (0, 1, 3, 4, 5) AS forced
  FROM docs
),
bills AS (
  SELECT t.*,
    CASE WHEN cls = 6 THEN 'error:FileNotFoundError' WHEN cls = 4 THEN 'error:ValueError' ELSE 'ok' END AS parse_status,
    CASE WHEN cls = 6 THEN file_path WHEN cls = 4 THEN 'empty_text_after_ocr' ELSE '' END AS parse_error,
    CAST(CASE WHEN cls IN (4, 6) THEN 0 WHEN cls = 2 THEN length(emb_text) ELSE length(clean_text) END AS BIGINT) AS text_len,
    CAST(coalesce(length(emb_text), 0) AS BIGINT) AS embedded_text_len,
    cls NOT IN (2, 4, 6) AS cfe_fields
  FROM texts t WHERE cls <> 11
)
"""

WITH = "WITH " + SRC

PARSED_COLUMNS = """
  CASE WHEN cfe_fields THEN 'CFE' WHEN cls = 2 THEN 'IBERDROLA' END AS source_utility,
  CASE WHEN cfe_fields THEN 'cfe_bill' WHEN cls = 2 THEN 'iberdrola_cfdi' END AS document_type,
  CASE WHEN cfe_fields OR cls = 2 THEN 'CLIENTE ' || ck END AS cliente_nombre,
  CASE WHEN cfe_fields THEN printf('%012d', okey) END AS no_servicio,
  CASE WHEN cfe_fields THEN '12AB' || printf('%08d', ck) END AS cuenta,
  CASE WHEN cfe_fields THEN '29010' || printf('%07d', ck) END AS rmu,
  CASE WHEN cfe_fields THEN 'ABC' || printf('%09d', ck) END AS rpu,
  CASE WHEN cfe_fields THEN strftime(fin + 15, '%Y-%m-%d') END AS limite_pago,
  CASE WHEN cfe_fields THEN strftime(fin + 16, '%Y-%m-%d') END AS corte_a_partir,
  CASE WHEN cfe_fields THEN CASE WHEN cls = 9 THEN strftime(ini, '%Y') || '-02-31'
                                 ELSE strftime(ini, '%Y-%m-%d') END END AS periodo_inicio,
  CASE WHEN cfe_fields THEN strftime(fin, '%Y-%m-%d') END AS periodo_fin,
  CASE WHEN cls = 2 THEN 'GDMTH' WHEN cfe_fields AND cls <> 7 THEN tariff END AS tarifa,
  CASE WHEN cfe_fields THEN CASE WHEN cls = 8 THEN 'M' || ck || 'NOHILOS' ELSE 'M' || ck END END AS medidor,
  CASE WHEN cfe_fields THEN '1' END AS multiplicador,
  CASE WHEN cfe_fields THEN '3' END AS no_hilos,
  CASE WHEN cfe_fields THEN CAST(kwh + 5000 AS VARCHAR) END AS lectura_actual_kwh,
  CASE WHEN cfe_fields THEN '5000' END AS lectura_anterior_kwh,
  CASE WHEN cfe_fields OR cls = 2 THEN CAST(kwh AS VARCHAR) END AS kwh_total,
  CASE WHEN cfe_fields OR cls = 2 THEN printf('%.2f', total) END AS importe_total,
  CASE WHEN cfe_fields THEN '70.10' END AS cargo_fijo,
  CASE WHEN cfe_fields THEN printf('%.2f', total) END AS subtotal_energia,
  CASE WHEN cfe_fields THEN printf('%.2f', total) END AS subtotal,
  CASE WHEN cfe_fields THEN '11.22' END AS iva,
  CASE WHEN cfe_fields THEN printf('%.2f', total) END AS fac_del_periodo,
  CASE WHEN cfe_fields THEN printf('%.2f', total) END AS total_linea,
  CASE WHEN cfe_fields THEN n_lines > 0 WHEN cls = 2 THEN false END AS tiene_consumo_historico,
  CAST(CASE WHEN cfe_fields THEN n_lines ELSE 0 END AS BIGINT) AS historico_count,
  file_path, file_name, mall AS mall_folder, sub AS recibos_subgroup,
  year_folder AS recibos_year_folder, year_num AS recibos_year,
  parse_status, parse_error, text_len, embedded_text_len,
  cls IN (0, 1, 3, 4, 5) AS used_ocr,
  CASE WHEN cls IN (0, 1, 3, 4, 5) THEN 'ocr' ELSE 'pdfplumber' END AS text_source,
  coalesce(reason, 'init') AS text_source_reason,
  CAST(2 AS BIGINT) AS extracted_pages
"""

HISTORY_SELECT = """
  SELECT b.file_path, b.file_name, b.mall AS mall_folder, b.sub AS recibos_subgroup,
    b.year_folder AS recibos_year_folder, b.year_num AS recibos_year,
    printf('%012d', b.okey) AS no_servicio, '12AB' || printf('%08d', b.ck) AS cuenta,
    CASE WHEN b.cls <> 7 THEN b.tariff END AS tarifa,
    CAST(h.idx AS BIGINT) AS historico_idx,
    h.hs_txt AS periodo_inicio_raw, h.he_txt AS periodo_fin_raw,
    CASE WHEN h.bad_start THEN strftime(h.hs, '%Y') || '-02-31' ELSE strftime(h.hs, '%Y-%m-%d') END AS periodo_inicio,
    strftime(h.he, '%Y-%m-%d') AS periodo_fin,
    CAST(h.hkwh AS VARCHAR) AS kwh, printf('%.2f', h.himp) AS importe,
    printf('%.2f', h.hpag) AS pagos_pendientes,
    h.bad_start, h.hs, h.he, h.hkwh, h.himp, h.hpag, b.cls
  FROM bills b JOIN hlines h ON b.okey = h.okey
  WHERE b.cfe_fields
"""

# Bills as the rollups see them: fields as text, coerced to numbers.
BILLS_NUM = f"""
, pb AS (SELECT {PARSED_COLUMNS} FROM bills),
x AS (
  SELECT mall_folder, recibos_subgroup, medidor, tarifa, periodo_inicio, periodo_fin,
         TRY_CAST(kwh_total AS DOUBLE) AS kwh, TRY_CAST(importe_total AS DOUBLE) AS imp,
         CASE WHEN TRY_CAST(kwh_total AS DOUBLE) > 0 AND importe_total IS NOT NULL
              THEN TRY_CAST(importe_total AS DOUBLE) / TRY_CAST(kwh_total AS DOUBLE) END AS mxn
  FROM pb
)
"""

TARIFF_LABELS = ["DB1", "GDBT", "GDMTH", "GDMTO", "PDBT", "nan"]

SHARES = """
, tc AS (
  SELECT mall_folder, recibos_subgroup, coalesce(tarifa, 'nan') AS tarifa, count(*) AS tarifa_bills
  FROM x GROUP BY ALL
),
sh AS (
  SELECT *, CASE WHEN mall_folder IS NOT NULL AND recibos_subgroup IS NOT NULL
                 THEN CAST(sum(tarifa_bills) OVER (PARTITION BY mall_folder, recibos_subgroup) AS BIGINT) END AS tarifa_bills_total
  FROM tc
)
"""

PIVOT = ", pv AS (SELECT mall_folder AS pm, recibos_subgroup AS ps, " + ", ".join(
    f"coalesce(max(CASE WHEN tarifa = '{t}' THEN CAST(tarifa_bills AS DOUBLE) / tarifa_bills_total END), 0.0) AS share_{t}"
    for t in TARIFF_LABELS) + " FROM sh WHERE tarifa_bills_total IS NOT NULL GROUP BY ALL)"

ROLLUP = """
, ru AS (
  SELECT mall_folder, recibos_subgroup, count(kwh) AS bills, count(DISTINCT medidor) AS meters,
    (floor((coalesce(sum(kwh), 0.0)) * 1e6 + 0.5) / 1e6) AS kwh_sum, (floor((avg(kwh)) * 1e6 + 0.5) / 1e6) AS kwh_mean_bill,
    (floor((coalesce(sum(imp), 0.0)) * 1e2 + 0.5) / 1e2) AS importe_sum, (floor((avg(mxn)) * 1e6 + 0.5) / 1e6) AS mxn_per_kwh_mean,
    coalesce(sum(kwh), 0.0) / nullif(count(DISTINCT medidor), 0) AS kwh_per_meter
  FROM x GROUP BY ALL
)
"""


def _hist_v2() -> str:
    return WITH + ", hb AS (" + HISTORY_SELECT + """),
hx AS (SELECT * FROM hb UNION ALL
       SELECT * REPLACE ('1' || no_servicio AS no_servicio) FROM hb WHERE cls = 16 UNION ALL
       SELECT * REPLACE ('1' || cuenta AS cuenta) FROM hb WHERE cls = 19),
hy AS (
  SELECT *, TRY_CAST(periodo_inicio AS DATE) AS d0, TRY_CAST(periodo_fin AS DATE) AS d1,
    CASE WHEN TRY_CAST(periodo_fin AS DATE) - TRY_CAST(periodo_inicio AS DATE) + 1 > 0
         THEN TRY_CAST(periodo_fin AS DATE) - TRY_CAST(periodo_inicio AS DATE) + 1 END AS bd,
    count(DISTINCT no_servicio) OVER (PARTITION BY file_path) AS ns,
    count(DISTINCT cuenta) OVER (PARTITION BY file_path) AS nc
  FROM hx
)
SELECT file_path, file_name, mall_folder, recibos_subgroup, recibos_year_folder, recibos_year,
  no_servicio, cuenta, tarifa, historico_idx, periodo_inicio_raw, periodo_fin_raw,
  CAST(d0 AS VARCHAR) AS periodo_inicio, CAST(d1 AS VARCHAR) AS periodo_fin,
  CAST(hkwh AS DOUBLE) AS kwh, himp AS importe, hpag AS pagos_pendientes,
  CAST(bd AS BIGINT) AS billing_days,
  coalesce(CAST(d0 AS VARCHAR), 'NaT') || '__' || coalesce(CAST(d1 AS VARCHAR), 'NaT') AS period_key,
  CAST(ns AS BIGINT) AS pdf_no_servicio_nunique, CAST(nc AS BIGINT) AS pdf_cuenta_nunique,
  ns > 1 AS flag_pdf_mixed_no_servicio, nc > 1 AS flag_pdf_mixed_cuenta,
  CASE WHEN bd > 0 THEN hkwh / bd END AS kwh_por_dia,
  CASE WHEN bd > 0 THEN himp / bd END AS importe_por_dia,
  CASE WHEN hkwh > 0 THEN himp / hkwh END AS costo_por_kwh,
  false AS flag_missing_kwh, (d0 IS NULL OR d1 IS NULL) AS flag_missing_dates,
  bd IS NULL AS flag_bad_days
FROM hy
"""


def _q4(num: str, den: str) -> str:
    """Exact half-even quotient to 4 places of non-negative integers num/den (scaled)."""
    return (f"CASE WHEN ({den}) = 0 THEN NULL ELSE CAST((({num}) * 10000 // ({den}) + "
            f"CASE WHEN 2 * ((({num}) * 10000) % ({den})) > ({den}) OR "
            f"(2 * ((({num}) * 10000) % ({den})) = ({den}) AND (({num}) * 10000 // ({den})) % 2 = 1) "
            f"THEN 1 ELSE 0 END) AS DOUBLE) / 10000 END")


def _doc_gate() -> str:
    """The gate rules in DuckDB/RE2 over ``documents`` (independent dialect)."""
    ws = " || ".join(f"chr({code})" for code in WHITE_SPACE)
    return f"""
WITH d AS (SELECT doc_id, text, trim(text, {ws}) AS s FROM documents),
f AS (
  SELECT doc_id, text IS NULL AS is_null, length(s) AS n,
    len(regexp_extract_all(s, 'cid:[0-9]+')) AS cid, upper(s) AS up,
    length(regexp_replace(s, '[^\\pL]', '', 'g')) AS letters,
    length(regexp_replace(s, '[\\pL\\pN \\n\\r\\t.,:;/\\-_()\\[\\]$%+°º''"]', '', 'g')) AS weird
  FROM d
),
g AS (
  SELECT *, CAST(contains(up, 'TARIFA') AS INTEGER) + CAST(contains(up, 'CUENTA') AS INTEGER)
      + CAST(contains(up, 'MEDIDOR') AS INTEGER) + CAST(contains(up, 'RPU') AS INTEGER)
      + CAST(regexp_matches(up, 'NO\\.?\\s+DE\\s+SERVICIO') AS INTEGER) AS hits,
    CAST(weird AS DOUBLE) / greatest(letters, 1) AS ratio
  FROM f
),
h AS (SELECT * FROM g),
r AS (
  SELECT *, CASE
    WHEN is_null THEN 'none_text'
    WHEN n < 80 THEN 'too_short<80'
    WHEN cid >= 50 THEN 'cid_garbage(' || cid || ')'
    WHEN contains(up, 'IBERDROLA') THEN CASE WHEN (contains(up, 'CATEGOR') AND contains(up, 'TARIF'))
         OR contains(up, 'DIVISIÓN TARIFARIA') OR contains(up, 'DIVISION TARIFARIA')
         THEN 'ok_iberdrola' ELSE 'iberdrola_missing_anchors' END
    WHEN hits < 2 THEN 'missing_strong_anchors(' || hits || ')'
    WHEN letters > 0 AND ratio > 0.35 THEN 'weird_ratio>' || printf('%.2f', ratio)
    ELSE 'ok' END AS gate_reason
  FROM h
)
SELECT doc_id, gate_reason, CAST(n AS BIGINT) AS text_len, CAST(cid AS BIGINT) AS cid,
  CAST(hits AS BIGINT) AS anchor_hits, CAST(letters AS BIGINT) AS letters,
  CAST(weird AS BIGINT) AS weird, gate_reason NOT IN ('ok', 'ok_iberdrola') AS force_ocr
FROM r"""


def oracle_queries() -> dict:
    q = {}
    q["document_gate"] = _doc_gate()
    q["bill_listing"] = WITH + """
SELECT file_path, file_name FROM paths WHERE cls <> 11"""
    q["path_metadata"] = WITH + """
SELECT file_path, file_name, mall AS mall_folder,
  CASE WHEN cls = 11 THEN NULL ELSE sub END AS recibos_subgroup,
  CASE WHEN cls = 11 THEN NULL ELSE year_folder END AS recibos_year_folder,
  CASE WHEN cls = 11 THEN NULL ELSE year_num END AS recibos_year
FROM paths
UNION ALL
SELECT replace(file_path, '.pdf', '.xml'), okey || '.xml', mall, seg, CAST(year(ini) AS VARCHAR),
  CAST(year(ini) AS BIGINT) FROM paths WHERE cls = 17
UNION ALL
SELECT '/bills/' || mall || '/0. Contratos/7. Recibos CFE/' || okey || '.pdf', okey || '.pdf', mall,
  NULL, NULL, NULL FROM paths WHERE cls = 18"""
    q["bills_index"] = WITH + """
SELECT file_path, file_name, mall AS mall_folder, sub AS recibos_subgroup,
  year_folder AS recibos_year_folder, year_num AS recibos_year
FROM paths WHERE cls <> 11"""
    q["first_paths"] = WITH + """
SELECT file_path FROM paths WHERE cls <> 11 ORDER BY lower(file_path), file_path LIMIT 100"""
    q["assemble_text"] = WITH + """
SELECT file_path, CAST(length(emb_text) AS BIGINT) AS text_len, md5(emb_text) AS text_md5
FROM texts WHERE cls <> 6"""
    q["text_gate"] = WITH + """
SELECT file_path, reason AS gate_reason, forced AS force_ocr, forced AS used_ocr,
  CASE WHEN forced THEN 'ocr' ELSE 'pdfplumber' END AS text_source,
  CAST(length(emb_text) AS BIGINT) AS embedded_text_len,
  CAST(CASE WHEN cls = 4 THEN 0 WHEN forced THEN length(clean_text) ELSE length(emb_text) END AS BIGINT) AS text_len
FROM texts WHERE cls <> 6"""
    q["parse_bills"] = WITH + "SELECT " + PARSED_COLUMNS + " FROM bills"
    q["bill_history"] = WITH + """
SELECT file_path, file_name, mall_folder, recibos_subgroup, recibos_year_folder, recibos_year,
  no_servicio, cuenta, tarifa, historico_idx, periodo_inicio_raw, periodo_fin_raw,
  periodo_inicio, periodo_fin, kwh, importe, pagos_pendientes
FROM (""" + HISTORY_SELECT + ")"
    q["history_features"] = _hist_v2()
    q["progress_records"] = WITH + """
SELECT file_path, CASE WHEN parse_status = 'ok' THEN 'ok' ELSE 'error' END AS status,
  cls IN (0, 1, 3, 4, 5) AS used_ocr,
  CASE WHEN cls IN (0, 1, 3, 4, 5) THEN 'ocr' ELSE 'pdfplumber' END AS text_source,
  coalesce(reason, 'init') AS reason, nullif(parse_error, '') AS error
FROM bills"""
    q["run_counters"] = WITH + """
SELECT count(*) FILTER (WHERE parse_status = 'ok') AS processed,
  count(*) FILTER (WHERE parse_status <> 'ok') AS errors, count(*) AS attempted FROM bills"""
    q["mall_rollup"] = WITH + BILLS_NUM + ROLLUP + "SELECT * FROM ru"
    q["tariff_shares"] = WITH + BILLS_NUM + SHARES + """
SELECT mall_folder, recibos_subgroup, tarifa, tarifa_bills, tarifa_bills_total,
  CAST(tarifa_bills AS DOUBLE) / tarifa_bills_total AS tarifa_share FROM sh"""
    q["tariff_pivot"] = WITH + BILLS_NUM + SHARES + PIVOT + """
SELECT pm AS mall_folder, ps AS recibos_subgroup, """ + ", ".join(
        f"share_{t}" for t in TARIFF_LABELS) + " FROM pv"
    q["mall_fingerprints"] = WITH + BILLS_NUM + SHARES + PIVOT + ROLLUP + """
SELECT ru.*, """ + ", ".join(f"pv.share_{t}" for t in TARIFF_LABELS) + """
FROM ru LEFT JOIN pv ON ru.mall_folder IS NOT DISTINCT FROM pv.pm
                     AND ru.recibos_subgroup IS NOT DISTINCT FROM pv.ps"""
    q["tenant_fingerprints"] = WITH + BILLS_NUM + """
, modes AS (
  SELECT mall_folder, recibos_subgroup, medidor, tarifa AS tarifa_mode FROM (
    SELECT mall_folder, recibos_subgroup, medidor, tarifa,
      row_number() OVER (PARTITION BY mall_folder, recibos_subgroup, medidor
                         ORDER BY count(*) DESC, tarifa) AS rn
    FROM x WHERE tarifa IS NOT NULL GROUP BY 1, 2, 3, 4) WHERE rn = 1
),
t AS (
  SELECT mall_folder, recibos_subgroup, medidor, count(kwh) AS bills_count,
    (floor((coalesce(sum(kwh), 0.0)) * 1e6 + 0.5) / 1e6) AS kwh_sum, (floor((avg(kwh)) * 1e6 + 0.5) / 1e6) AS kwh_mean,
    (floor((median(kwh)) * 1e6 + 0.5) / 1e6) AS kwh_median, (floor((coalesce(sum(imp), 0.0)) * 1e2 + 0.5) / 1e2) AS importe_sum,
    (floor((avg(imp)) * 1e6 + 0.5) / 1e6) AS importe_mean, (floor((avg(mxn)) * 1e6 + 0.5) / 1e6) AS mxn_per_kwh_mean,
    (floor((median(mxn)) * 1e6 + 0.5) / 1e6) AS mxn_per_kwh_median,
    min(TRY_CAST(periodo_inicio AS DATE)) AS d0, max(TRY_CAST(periodo_fin AS DATE)) AS d1
  FROM x GROUP BY ALL
)
SELECT t.mall_folder, t.recibos_subgroup, t.medidor, m.tarifa_mode, bills_count, kwh_sum, kwh_mean,
  kwh_median, importe_sum, importe_mean, mxn_per_kwh_mean, mxn_per_kwh_median,
  CASE WHEN t.mall_folder IS NOT NULL AND t.recibos_subgroup IS NOT NULL AND t.medidor IS NOT NULL
       THEN CAST(d0 AS VARCHAR) END AS first_periodo_inicio,
  CASE WHEN t.mall_folder IS NOT NULL AND t.recibos_subgroup IS NOT NULL AND t.medidor IS NOT NULL
       THEN CAST(d1 AS VARCHAR) END AS last_periodo_fin,
  CASE WHEN t.mall_folder IS NOT NULL AND t.recibos_subgroup IS NOT NULL AND t.medidor IS NOT NULL
       THEN round((d1 - d0) / 30.0, 1) END AS months_span
FROM t LEFT JOIN modes m ON t.mall_folder IS NOT DISTINCT FROM m.mall_folder
  AND t.recibos_subgroup IS NOT DISTINCT FROM m.recibos_subgroup
  AND t.medidor IS NOT DISTINCT FROM m.medidor"""
    q["meter_profile"] = WITH + BILLS_NUM + """
SELECT medidor, (floor((avg(kwh)) * 1e6 + 0.5) / 1e6) AS avg_kwh, count(*) AS bills FROM x
WHERE medidor IS NOT NULL GROUP BY medidor"""
    q["tariff_value_counts"] = WITH + BILLS_NUM + """
SELECT coalesce(tarifa, 'nan') AS tarifa, count(*) AS count FROM x GROUP BY 1
ORDER BY count DESC, tarifa LIMIT 20"""
    q["unique_meters"] = WITH + BILLS_NUM + """
SELECT count(DISTINCT medidor) AS unique_medidor FROM x"""
    q["kwh_describe"] = WITH + BILLS_NUM + """
SELECT CAST(count(kwh) AS DOUBLE) AS count, (floor((avg(kwh)) * 1e6 + 0.5) / 1e6) AS mean,
  (floor((stddev_samp(kwh)) * 1e6 + 0.5) / 1e6) AS std, (floor((min(kwh)) * 1e6 + 0.5) / 1e6) AS min,
  (floor((quantile_cont(kwh, 0.25)) * 1e6 + 0.5) / 1e6) AS p25, (floor((quantile_cont(kwh, 0.5)) * 1e6 + 0.5) / 1e6) AS p50,
  (floor((quantile_cont(kwh, 0.75)) * 1e6 + 0.5) / 1e6) AS p75, (floor((max(kwh)) * 1e6 + 0.5) / 1e6) AS max
FROM x WHERE kwh IS NOT NULL"""
    q["kwh_histogram"] = WITH + BILLS_NUM + """
, st AS (SELECT min(kwh) AS mn, max(kwh) AS mx FROM x WHERE kwh IS NOT NULL),
e AS (SELECT CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo,
             CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi FROM st WHERE mn IS NOT NULL),
b AS (SELECT least(greatest(CAST(floor((kwh - lo) * (30.0 / (hi - lo))) AS BIGINT), 0), 29) AS bin
      FROM x, e WHERE kwh IS NOT NULL),
g AS (SELECT range AS bin FROM range(30))
SELECT CAST(g.bin AS BIGINT) AS bin, g.bin * ((hi - lo) / CAST(30 AS DOUBLE)) + lo AS bin_lo,
  CASE WHEN g.bin + 1 >= 30 THEN hi ELSE (g.bin + 1) * ((hi - lo) / CAST(30 AS DOUBLE)) + lo END AS bin_hi,
  (SELECT count(*) FROM b WHERE b.bin = g.bin) AS count
FROM g, e"""
    q["row_count"] = WITH + """
SELECT count(*) AS rows, CAST(""" + str(len(BILL_COLUMNS)) + """ AS BIGINT) AS n_columns,
  '""" + ",".join(BILL_COLUMNS) + """' AS columns
FROM bills"""
    q["canonical_metrics"] = WITH + BILLS_NUM.replace("x AS (", "xx AS (") + """
, c AS (
  SELECT b.file_path, b.cls, b.parse_status, b.total, b.kwh AS k, b.ini, b.fin,
    b.okey % 7 * 125 AS kwc, b.okey % 11 * 1234 AS demc,
    pb.tarifa, pb.medidor, pb.kwh_total, pb.importe_total, pb.periodo_inicio, pb.periodo_fin
  FROM bills b JOIN pb ON b.file_path = pb.file_path
), d AS (
  SELECT *, TRY_CAST(periodo_inicio AS DATE) AS d0, TRY_CAST(periodo_fin AS DATE) AS d1,
    CASE WHEN TRY_CAST(periodo_fin AS DATE) - TRY_CAST(periodo_inicio AS DATE) + 1 > 0
         THEN TRY_CAST(periodo_fin AS DATE) - TRY_CAST(periodo_inicio AS DATE) + 1 END AS dias,
    CAST(round(total * 100) AS BIGINT) AS cents
  FROM c
)
SELECT file_path,
  CASE WHEN parse_status <> 'ok' THEN 'error'
       WHEN periodo_inicio IS NOT NULL AND d0 IS NULL THEN 'error' ELSE 'ok' END AS canonical_status,
  CASE WHEN tarifa IN ('GDBT', 'GDMTO', 'GDMTH', 'PDBT') THEN tarifa ELSE 'UNKNOWN' END AS tarifa,
  medidor AS no_medidor, CAST(dias AS BIGINT) AS dias_facturados,
  CAST(kwh_total AS DOUBLE) AS kwh_total, CAST(importe_total AS DOUBLE) AS importe_total,
  CASE WHEN kwh_total IS NOT NULL AND dias IS NOT NULL THEN """ + _q4("k", "dias") + """ END AS kwh_per_day,
  CASE WHEN importe_total IS NOT NULL AND kwh_total IS NOT NULL THEN """ + _q4("cents", "k * 100") + """ END AS cost_per_kwh,
  CASE WHEN kwh_total IS NOT NULL AND dias IS NOT NULL THEN """ + _q4("k * 100", "kwc * 24 * dias") + """ END AS load_factor,
  CASE WHEN importe_total IS NOT NULL THEN """ + _q4("demc", "cents") + """ END AS demand_ratio
FROM d"""
    demand = """
, w AS (
  SELECT TRY_CAST(pb.kwh_total AS DOUBLE) AS kwh, pb.medidor, (b.okey % 7 * 125) / 100.0 AS kw
  FROM bills b JOIN pb ON b.file_path = pb.file_path)"""

    def six(x: str) -> str:
        return f"floor(({x}) * 1e6 + 0.5) / 1e6"

    def desc(x: str, name: str) -> str:
        return (f"CAST(count({x}) AS DOUBLE) AS {name}_count, {six(f'avg({x})')} AS {name}_mean, "
                f"{six(f'stddev_samp({x})')} AS {name}_std, {six(f'min({x})')} AS {name}_min, "
                + "".join(f"{six(f'quantile_cont({x}, {p / 100})')} AS {name}_p{p}, " for p in (25, 50, 75))
                + f"{six(f'max({x})')} AS {name}_max")
    q["meter_profile_kw"] = WITH + BILLS_NUM + demand + f"""
SELECT medidor, {six('avg(kwh)')} AS avg_kwh, {six('avg(kw)')} AS avg_kw, count(*) AS bills,
  CASE WHEN avg(kw) <> 0 THEN {six('avg(kwh) / (avg(kw) * 720.0)')} END AS load_factor
FROM w WHERE medidor IS NOT NULL GROUP BY medidor"""
    q["dataset_profile"] = WITH + BILLS_NUM + demand + f"""
, lf AS (SELECT *, CASE WHEN kw <> 0 THEN kwh / (kw * 720.0) END AS lf FROM w)
SELECT count(*) AS rows, count(DISTINCT medidor) AS unique_meters, {desc('kwh', 'kwh_desc')},
  {desc('kw', 'kw_desc')}, {desc('lf', 'load_factor_desc')} FROM lf"""
    q["first_index_rows"] = WITH + """
SELECT file_path, file_name, mall AS mall_folder, sub AS recibos_subgroup,
  year_folder AS recibos_year_folder, year_num AS recibos_year
FROM paths WHERE cls <> 11
ORDER BY mall NULLS LAST, sub NULLS LAST, year_num NULLS LAST, file_name LIMIT 100"""
    q["first_malls"] = q["mall_fingerprints"] + " ORDER BY ru.mall_folder NULLS LAST, ru.recibos_subgroup NULLS LAST LIMIT 20"
    q["tariff_map"] = WITH + BILLS_NUM + SHARES + """
SELECT mall_folder, recibos_subgroup, string_agg(tarifa || '='
         || printf('%.9f', CAST(tarifa_bills AS DOUBLE) / tarifa_bills_total), ',' ORDER BY tarifa) AS shares
FROM sh WHERE tarifa_bills_total IS NOT NULL GROUP BY ALL"""
    q["incremental_runs"] = WITH + """
SELECT file_path, parse_status, CASE WHEN cfe_fields OR cls = 2 THEN CAST(kwh AS VARCHAR) END AS kwh_total,
  CAST(CASE WHEN cfe_fields THEN n_lines ELSE 0 END AS BIGINT) AS history_rows
FROM bills"""
    q["analysis_run"] = WITH + BILLS_NUM + """
SELECT 'kwh_histogram' AS output, 30 AS rows UNION ALL SELECT 'profile', 1
UNION ALL SELECT 'malls', count(*) FROM (SELECT DISTINCT mall_folder, recibos_subgroup FROM x)
UNION ALL SELECT 'tenants', count(*) FROM (SELECT DISTINCT mall_folder, recibos_subgroup, medidor FROM x)
UNION ALL SELECT 'meters', count(DISTINCT medidor) FROM x
UNION ALL SELECT 'tariff_shares', count(*) FROM (SELECT DISTINCT mall_folder, recibos_subgroup, tarifa FROM x)
UNION ALL SELECT 'tariff_counts', count(*) FROM (SELECT DISTINCT tarifa FROM x)"""
    q["done_files"] = WITH + """
SELECT file_path FROM paths WHERE cls <> 11 AND okey % 2 = 0"""
    q["resume_filter"] = WITH + """
SELECT file_path, file_name, mall AS mall_folder, sub AS recibos_subgroup,
  year_folder AS recibos_year_folder, year_num AS recibos_year
FROM paths WHERE cls <> 11 AND okey % 2 = 1"""
    q["incremental_parse"] = WITH + """
SELECT file_path, CASE WHEN parse_status = 'ok' THEN 'ok' ELSE 'error' END AS status,
  cls IN (0, 1, 3, 4, 5) AS used_ocr,
  CASE WHEN cls IN (0, 1, 3, 4, 5) THEN 'ocr' ELSE 'pdfplumber' END AS text_source,
  coalesce(reason, 'init') AS reason, nullif(parse_error, '') AS error
FROM bills WHERE okey % 2 = 1"""
    key = "printf('%012d', okey)"
    spaced = " || ' ' || ".join(f"substr({key}, {k}, 3)" for k in (1, 4, 7, 10))
    ini = f"CASE WHEN cls = 9 THEN '31 FEB ' || strftime(ini, '%y') ELSE {_es('ini')} END"
    # field, the text before its snippet, the snippet
    places = [
        ("cliente_nombre", "''", "'CLIENTE ' || ck"), ("no_servicio", "'NO. DE SERVICIO: '", spaced),
        ("cuenta", "'CUENTA: '", "'12-AB' || printf('%08d', ck)"), ("rmu", "'RMU: '", "'29010 ' || printf('%07d', ck)"),
        ("rpu", "'RPU: '", "'ABC' || printf('%09d', ck)"), ("limite_pago", "'LÍMITE DE PAGO: '", _es("fin + 15")),
        ("corte_a_partir", "'CORTE A PARTIR: '", _es("fin + 16")), ("periodo_inicio", "'Periodo facturado: '", ini),
        ("periodo_fin", f"'Periodo facturado: ' || {ini} || ' - '", _es("fin")),
        ("tarifa", "'TARIFA: '", "CASE WHEN cls <> 7 THEN CASE WHEN tariff = 'DB1' THEN tariff ELSE tariff || 'NO' END END"),
        ("medidor", "'MEDIDOR: '", "CASE WHEN cls = 8 THEN 'M' || ck || ' NO HILOS' ELSE 'M' || ck END"),
        ("multiplicador", "'MULTIPLICADOR: '", "'1'"), ("no_hilos", "'NO HILOS: '", "'3'"),
        ("lectura_actual_kwh", "'Energía (kWh) '", _f0("kwh + 5000")), ("lectura_anterior_kwh", f"'Energía (kWh) ' || {_f0('kwh + 5000')} || ' '", "'5,000'"),
        ("kwh_total", f"'Energía (kWh) ' || {_f0('kwh + 5000')} || ' 5,000 '", _f0("kwh")),
        ("importe_total", "'TOTAL A PAGAR:' || chr(10) || '$'", _f2("total")), ("cargo_fijo", "'Cargo Fijo mensual '", "'70.10'"),
        ("subtotal_energia", "chr(10) || 'Energía '", _f2("total")), ("subtotal", "'Subtotal '", _f2("total")), ("iva", "'IVA 16% '", "'11.22'"),
        ("fac_del_periodo", "'Fac. del Periodo '", _f2("total")), ("total_linea", "chr(10) || 'Total '", _f2("total"))]
    other = [("cliente_nombre", "''", "'CLIENTE ' || ck"), ("importe_total", "'TOTAL A PAGAR:' || chr(10) || '$'", _f2("total")),
             ("tarifa", "'Categoría Tarifaria '", "'GDMTH'"), ("kwh_total", "'Consumo '", _f0("kwh"))]

    def evidence(rows: list, where: str) -> str:
        one = [f"{{'field': '{f}', 'before': {b}, 'snippet': {s}}}" for f, b, s in rows]
        return f"SELECT file_path, t, unnest([{', '.join(one)}]) AS e FROM src_texts WHERE {where}"
    q["bill_evidence"] = WITH + f"""
, src_texts AS (SELECT *, CASE WHEN cls = 2 THEN emb_text ELSE clean_text END AS t FROM bills)
, seen AS ({evidence(places, 'cfe_fields')} UNION ALL {evidence(other, 'cls = 2')})
SELECT file_path, e.field AS field, e.snippet AS snippet, strpos(t, e.before || e.snippet) + length(e.before) AS "offset"
FROM seen WHERE e.snippet IS NOT NULL"""
    q["page_store_resume"] = q["incremental_parse"]
    q["compacted_runs"] = q["incremental_runs"]
    q["maintained_malls"], q["maintained_tenants"] = q["mall_rollup"], q["tenant_fingerprints"]
    q["maintained_tariffs"] = WITH + BILLS_NUM + """
SELECT mall_folder, recibos_subgroup, coalesce(tarifa, 'nan') AS tarifa, count(*) AS tarifa_bills FROM x GROUP BY ALL"""
    q["run_table"] = WITH + """
, r AS (SELECT 1 AS number, * FROM bills WHERE okey % 2 = 0
  UNION ALL SELECT 2, * FROM bills WHERE okey % 2 = 1 OR parse_status <> 'ok'
  UNION ALL SELECT 3, * FROM bills WHERE okey % 3 = 0)
SELECT number, count(*) FILTER (parse_status = 'ok') AS processed, count(*) FILTER (parse_status <> 'ok') AS errors,
  CASE number WHEN 2 THEN (SELECT count(*) FROM bills WHERE okey % 2 = 0 AND parse_status = 'ok') ELSE 0 END AS skipped
FROM r GROUP BY number"""
    q["page_stream"] = WITH + """
SELECT file_path, parse_status, reason AS text_source_reason, text_len, kwh_total FROM (""" + "SELECT *, reason FROM (SELECT " + PARSED_COLUMNS + """, reason
FROM bills)) WHERE parse_status <> 'error:FileNotFoundError'"""
    q["rejected_lines"] = WITH + """
SELECT 'done' AS kind, file_path AS value FROM paths WHERE cls <> 11 AND okey % 2 = 0
UNION ALL SELECT 'rejected', '{"file_path": "' || file_path FROM paths WHERE cls <> 11 AND (okey % 10 = 4 OR okey % 10 = 5)"""
    q["sorted_index"] = WITH + """
SELECT file_path, file_name, mall AS mall_folder, sub AS recibos_subgroup, year_folder AS recibos_year_folder, year_num AS recibos_year,
  row_number() OVER (ORDER BY mall NULLS LAST, sub NULLS LAST, year_num NULLS LAST, file_name) AS position
FROM paths WHERE cls <> 11"""
    q["sorted_malls"] = "SELECT *, row_number() OVER (ORDER BY mall_folder NULLS LAST, recibos_subgroup NULLS LAST) AS position FROM (" \
        + q["mall_fingerprints"] + ")"
    return q
