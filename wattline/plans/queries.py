"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables (through the rendered bill source)
and runs over all of them. Output types are normalised for the SQL
cross-check (``compare_types``): integers as bigint, decimals as double,
dates as ISO text.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.functions.numeric import billing_days, to_date_or_null
from wattline.operators.canonical import canonical_bill, derived_metrics
from wattline.operators.fingerprints import (
    mall_fingerprints, mall_rollup, meter_profile, tariff_map, tariff_pivot, tariff_shares,
    tenant_fingerprints,
)
from wattline.operators.gate import (
    assemble_text, choose_text_source, gate_features, gate_reason, text_gate,
)
from wattline.operators.history import history_features
from wattline.operators.paths import build_index, numbered, read_listing, sort_index, sort_paths
from wattline.operators.profile import dataset_profile, describe, histogram, row_count_and_columns, \
    unique_count, value_counts
from wattline.plans.analysis import analyze
from wattline.plans import rollup_state
from wattline.plans.incremental import compact, committed, done_files, incremental_parse, quarantine, read_progress, \
    resume_filter, rollup_counts, run_table
from wattline.plans.parse import bill_history, bills_table, parse_bills, progress_records, \
    run_counters
from wattline.session import checkpoint_dir
from wattline.sources.page_store import write_page_store
from wattline.sources.rendered import ROOT, render_bills
from wattline.streaming.stream import stream_pages

MAX_PAGES = 2
FIRST_N = 100
# The tariff labels that the rendered bills hold (missing: 'nan').
TARIFFS = ["DB1", "GDBT", "GDMTH", "GDMTO", "PDBT", "nan"]


def compare_types(df: DataFrame, round_cols: dict | None = None) -> DataFrame:
    """Cast to the plain types both engines share; round listed doubles."""
    round_cols = round_cols or {}
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        if f.name in round_cols:
            # floor(x * 10^k + 0.5) / 10^k: plain IEEE steps, the same in any engine.
            scale = float(10 ** round_cols[f.name])
            c = F.floor(c.cast("double") * F.lit(scale) + F.lit(0.5)) / F.lit(scale)
        out.append(c.alias(f.name))
    return df.select(*out)


def _src(spark: SparkSession, sf_dir: str):
    return render_bills(spark, sf_dir)


def _index(spark, sf_dir):
    return build_index(_src(spark, sf_dir).listing, ROOT)


def _parsed(spark, sf_dir, keep_rows=True):
    b = _src(spark, sf_dir)
    return parse_bills(build_index(b.listing, ROOT), b.pages, b.alternate_pages,
                       max_pages=MAX_PAGES, keep_rows=keep_rows)


def _with_demand(bills: DataFrame) -> DataFrame:
    """Adds a maximum demand and a demand charge, made of the order key, as text."""
    key = F.regexp_extract("file_name", r"^(\d+)", 1).cast("long")

    def cents(c):
        return F.concat(F.floor(c / 100).cast("string"), F.lit("."), F.lpad((c % 100).cast("string"), 2, "0"))
    return bills.withColumn("kw_max_demand", cents(key % 7 * 125)).withColumn("cargo_demanda", cents(key % 11 * 1234))


def _folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _stored(rows: DataFrame, name: str) -> DataFrame:
    """A written copy, for queries that read their rows several times."""
    path = _folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _bills(spark, sf_dir):
    return bills_table(_parsed(spark, sf_dir, keep_rows=False)).drop("parsed_at")


# ---- sources, paths, index ------------------------------------------------

def q_bill_listing(spark, sf_dir):
    df = read_listing(_src(spark, sf_dir).listing, ROOT)
    return df.select("file_path", F.element_at(F.split("file_path", "/"), -1).alias("file_name"))


def q_path_metadata(spark, sf_dir):
    return compare_types(build_index(_src(spark, sf_dir).listing, ROOT, apply_listing_rule=False))


def q_bills_index(spark, sf_dir):
    return compare_types(_index(spark, sf_dir))


def q_first_paths(spark, sf_dir):
    return sort_paths(read_listing(_src(spark, sf_dir).listing, ROOT), FIRST_N)


def q_first_index_rows(spark, sf_dir):
    """O1: the first rows of the sorted index."""
    idx = build_index(_src(spark, sf_dir).listing, ROOT, sort=True)
    return compare_types(idx.limit(FIRST_N))


# ---- text ------------------------------------------------------------------

def q_assemble_text(spark, sf_dir):
    t = assemble_text(_src(spark, sf_dir).pages, MAX_PAGES)
    return compare_types(t.select("file_path", F.length("text").alias("text_len"),
                                  F.md5("text").alias("text_md5")))


def q_text_gate(spark, sf_dir):
    b = _src(spark, sf_dir)
    gated = text_gate(assemble_text(b.pages, MAX_PAGES))
    alt = assemble_text(b.alternate_pages, MAX_PAGES, skip_empty=True) \
        .withColumnRenamed("text", "alt_text")
    ch = choose_text_source(gated, alt)
    return compare_types(ch.select("file_path", "gate_reason", "force_ocr", "used_ocr",
                                   "text_source", "embedded_text_len", "text_len"))


def q_document_gate(spark, sf_dir):
    """G1-G7 over the whole texts of the ``documents`` table, with features."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    feats = docs.select("doc_id", *gate_features("text"))
    out = feats.select(
        "doc_id", gate_reason(80).alias("gate_reason"),
        F.col("_g_len").alias("text_len"), F.col("_g_cid").alias("cid"),
        F.col("_g_hits").alias("anchor_hits"), F.col("_g_letters").alias("letters"),
        F.col("_g_weird").alias("weird"))
    return compare_types(out.withColumn(
        "force_ocr", ~F.col("gate_reason").isin("ok", "ok_iberdrola")))


# ---- parse -------------------------------------------------------------------

def q_parse_bills(spark, sf_dir):
    return compare_types(_bills(spark, sf_dir))


def q_bill_evidence(spark, sf_dir):
    """P10: of every field that was read, the snippet and its place in the assembled text, through the canonical record."""
    b = _src(spark, sf_dir)
    parsed = parse_bills(build_index(b.listing, ROOT), b.pages, b.alternate_pages, MAX_PAGES, keep_rows=False, evidence=True)
    # Stored first: conditions on the map would otherwise be pushed down to where it is made.
    bill = canonical_bill(_stored(bills_table(parsed), "evidence")).select("bill.provenance.file_path", "bill.evidence", "bill.evidence_offsets")
    each = bill.select("file_path", "evidence_offsets", F.explode("evidence").alias("field", "snippet"))
    return compare_types(each.select("file_path", "field", "snippet", F.col("evidence_offsets")[F.col("field")].alias("offset")))


def q_bill_history(spark, sf_dir):
    return compare_types(bill_history(_parsed(spark, sf_dir)))


def _history_with_second_contract(spark, sf_dir):
    """Class 16 files get a second copy of their rows under another contract, class 19 files under another account."""
    h = _stored(bill_history(_parsed(spark, sf_dir)), "history-rows")
    key = F.regexp_extract(F.col("file_name"), r"^(\d+)\.", 1).cast("long")
    extra = h.where(key % 100 == 16).withColumn(
        "no_servicio", F.concat(F.lit("1"), F.col("no_servicio")))
    account = h.where(key % 100 == 19).withColumn("cuenta", F.concat(F.lit("1"), F.col("cuenta")))
    return h.unionByName(extra).unionByName(account)


def q_history_features(spark, sf_dir):
    # Read several times: stored first.
    return compare_types(history_features(_stored(_history_with_second_contract(spark, sf_dir), "history")))


def q_progress_records(spark, sf_dir):
    return compare_types(progress_records(_parsed(spark, sf_dir, keep_rows=False)).drop("at"))


def q_run_counters(spark, sf_dir):
    return compare_types(run_counters(_parsed(spark, sf_dir, keep_rows=False)))


# ---- rollups -----------------------------------------------------------------

_MONEY = {"importe_sum": 2, "importe_mean": 6}
_RATIO = {"kwh_mean_bill": 6, "mxn_per_kwh_mean": 6, "kwh_mean": 6,
          "kwh_median": 6, "mxn_per_kwh_median": 6, "kwh_sum": 6}


def q_mall_rollup(spark, sf_dir):
    return compare_types(mall_rollup(_bills(spark, sf_dir)), {**_MONEY, **_RATIO})


def q_tariff_shares(spark, sf_dir):
    return compare_types(tariff_shares(_bills(spark, sf_dir)), _RATIO)


def q_tariff_pivot(spark, sf_dir):
    wide = tariff_pivot(_bills(spark, sf_dir), TARIFFS)
    return compare_types(wide)


def q_tariff_map(spark, sf_dir):
    shares = tariff_map(_bills(spark, sf_dir))
    entries = F.transform(F.map_entries("tarifa_shares"), lambda e: F.concat(
        e["key"], F.lit("="), F.format_string("%.9f", e["value"])))
    return shares.select("mall_folder", "recibos_subgroup", F.array_join(entries, ",").alias("shares"))


def q_mall_fingerprints(spark, sf_dir):
    fp = mall_fingerprints(_bills(spark, sf_dir), TARIFFS)
    return compare_types(fp, {**_MONEY, **_RATIO})


def q_first_malls(spark, sf_dir):
    """The first rows of the sorted rollup."""
    fp = mall_fingerprints(_bills(spark, sf_dir), TARIFFS, sort=True).limit(20)
    return compare_types(fp, {**_MONEY, **_RATIO})


def q_tenant_fingerprints(spark, sf_dir):
    return compare_types(tenant_fingerprints(_bills(spark, sf_dir)), {**_MONEY, **_RATIO})


def q_meter_profile(spark, sf_dir):
    return compare_types(meter_profile(_bills(spark, sf_dir), "medidor", "kwh_total"),
                         {"avg_kwh": 6})


def q_meter_profile_kw(spark, sf_dir):
    """A10, P16 with a demand column."""
    p = meter_profile(_with_demand(_bills(spark, sf_dir)), "medidor", "kwh_total", "kw_max_demand")
    return compare_types(p, {"avg_kwh": 6, "avg_kw": 6, "load_factor": 6})


def q_dataset_profile(spark, sf_dir):
    """S7, A9 on demand and load factor, roles picked from the candidate names."""
    # Every part of the profile reads the bills: stored first.
    bills = _stored(_with_demand(_bills(spark, sf_dir)).withColumnsRenamed({"kwh_total": "kwh", "kw_max_demand": "kw_max"}), "profiled")
    p = dataset_profile(bills)
    flat = p.select("rows", F.col("unique_meters").alias("unique_meters"),
                    *[F.col(f"{d}.{c}").alias(f"{d}_{c}") for d in ("kwh_desc", "kw_desc", "load_factor_desc")
                      for c in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")])
    return compare_types(flat, {c: 6 for c in flat.columns if c[-5:] != "count" and c.startswith(("kw", "load"))})


# ---- profile -----------------------------------------------------------------

def q_tariff_value_counts(spark, sf_dir):
    return value_counts(_bills(spark, sf_dir), "tarifa", 20)


def q_unique_meters(spark, sf_dir):
    return unique_count(_bills(spark, sf_dir), "medidor")


def q_kwh_describe(spark, sf_dir):
    d = describe(_bills(spark, sf_dir), "kwh_total")
    return compare_types(d, {c: 6 for c in d.columns if c != "count"})


def q_kwh_histogram(spark, sf_dir):
    return compare_types(histogram(_bills(spark, sf_dir), "kwh_total", 30))


def q_row_count(spark, sf_dir):
    r = row_count_and_columns(_bills(spark, sf_dir))
    return r.select("rows", F.size("columns").cast("bigint").alias("n_columns"),
                    F.array_join("columns", ",").alias("columns"))


# ---- canonical -----------------------------------------------------------------

def q_canonical_metrics(spark, sf_dir):
    bills = _bills(spark, sf_dir)
    flat = _with_demand(bills).withColumn("dias_facturados", billing_days(
        to_date_or_null("periodo_inicio"), to_date_or_null("periodo_fin")).cast("string"))
    m = derived_metrics(canonical_bill(flat))
    b = F.col("bill")
    return compare_types(m.select(
        b["provenance"]["file_path"].alias("file_path"),
        b["provenance"]["parse_status"].alias("canonical_status"),
        b["ids"]["tarifa"].alias("tarifa"),
        b["ids"]["no_medidor"].alias("no_medidor"),
        b["period"]["dias_facturados"].alias("dias_facturados"),
        b["energy"]["kwh_total"].alias("kwh_total"),
        b["charges"]["importe_total"].alias("importe_total"),
        "kwh_per_day", "cost_per_kwh", "load_factor", "demand_ratio",
    ))


# ---- incremental -----------------------------------------------------------------

def progress_log(spark, sf_dir) -> DataFrame:
    """A stored progress log derived from the orders (FIXTURES.md §2)."""
    b = _src(spark, sf_dir)
    idx = build_index(b.listing, ROOT)
    key = F.regexp_extract(F.col("file_name"), r"^(\d+)\.", 1).cast("long")
    base = idx.select("file_path", key.alias("k"))
    rec = lambda st, err: F.struct(F.lit(st).alias("status"), F.lit(err).alias("error"))  # noqa
    recs = F.when(F.col("k").isNull(), F.array()).otherwise(
        F.when(F.col("k") % 10 == 4, F.array(rec("ok", None), rec("error", "boom")))
        .when(F.col("k") % 2 == 0, F.array(rec("ok", None)))
        .when(F.col("k") % 10 == 5, F.array(rec("error", "boom")))
        .otherwise(F.array()))
    return base.select("file_path", F.explode(recs.cast(
        "array<struct<status:string,error:string>>")).alias("r")).select(
        "file_path", "r.status", F.lit(False).alias("used_ocr"),
        F.lit("pdfplumber").alias("text_source"), F.lit("ok").alias("reason"),
        F.lit("2025-01-01T00:00:00").alias("at"), "r.error")


def q_done_files(spark, sf_dir):
    return done_files(progress_log(spark, sf_dir))


def q_resume_filter(spark, sf_dir):
    return compare_types(resume_filter(_index(spark, sf_dir), progress_log(spark, sf_dir)))


def q_incremental_parse(spark, sf_dir):
    b = _src(spark, sf_dir)
    todo = resume_filter(build_index(b.listing, ROOT), progress_log(spark, sf_dir))
    parsed = parse_bills(todo, b.pages, b.alternate_pages, MAX_PAGES, keep_rows=False, prune=True)
    return compare_types(progress_records(parsed).drop("at"))


def q_page_store_resume(spark, sf_dir):
    """J5 from a page store: what is left to do is joined with the pages' buckets before any text is assembled."""
    b = _src(spark, sf_dir)
    store = write_page_store(spark, _folder(spark, "page-store"), b.pages, b.listing, b.alternate_pages, buckets=16)
    todo = resume_filter(build_index(store.listing(), ROOT), progress_log(spark, sf_dir))
    parsed = parse_bills(todo, store.pages(todo), store.alternate_pages(todo), MAX_PAGES, keep_rows=False)
    return compare_types(progress_records(parsed).drop("at"))


def _three_runs(spark, sf_dir) -> str:
    """A folder of three runs: half of the files, all with resume, and a third of them again without it."""
    b = _src(spark, sf_dir)
    out = _folder(spark, "runs")
    for name, rows in (("listing", b.listing), ("pages", b.pages), ("alternates", b.alternate_pages)):
        rows.write.parquet(f"{out}-{name}")
    listing, pages, alternates = (spark.read.parquet(f"{out}-{name}") for name in ("listing", "pages", "alternates"))
    idx = build_index(listing, ROOT)
    key = F.regexp_extract("file_name", r"^(\d+)", 1).cast("long")
    incremental_parse(spark, idx.where(key % 2 == 0), pages, alternates, out)
    incremental_parse(spark, idx, pages, alternates, out)
    incremental_parse(spark, idx.where(key % 3 == 0), pages, alternates, out, resume=False)
    return out


def q_compacted_runs(spark, sf_dir):
    """The committed rows of three runs after their compaction into one base."""
    out = _three_runs(spark, sf_dir)
    compact(spark, out)
    bills = committed(spark, out, "bills").select("file_path", "parse_status", "kwh_total")
    history = committed(spark, out, "history_v2").groupBy("file_path").agg(F.count(F.lit(1)).alias("history_rows"))
    return bills.join(history, "file_path", "left").na.fill(0, ["history_rows"])


def _state(spark, sf_dir) -> DataFrame:
    """The maintained state of three runs, one of which replaces files."""
    return rollup_state.merged(rollup_counts(spark, _three_runs(spark, sf_dir)))


def q_maintained_malls(spark, sf_dir):
    """A1 from the signed counts of three runs."""
    return compare_types(rollup_state.malls(_state(spark, sf_dir)), {**_MONEY, **_RATIO})


def q_maintained_tenants(spark, sf_dir):
    """A5 from the signed counts of three runs."""
    return compare_types(rollup_state.tenants(_state(spark, sf_dir)), {**_MONEY, **_RATIO})


def q_maintained_tariffs(spark, sf_dir):
    """A2 from the signed counts of three runs."""
    return compare_types(rollup_state.tariffs(_state(spark, sf_dir)))


def q_run_table(spark, sf_dir):
    """The counters of three runs, observed while they were written."""
    runs = run_table(spark, _three_runs(spark, sf_dir))
    number = F.row_number().over(Window.orderBy("run"))
    return compare_types(runs.select(number.alias("number"), "processed", "errors", "skipped"))


def q_page_stream(spark, sf_dir):
    """Pages that arrive in files out of order, the first pages twice; the committed bills."""
    b = _src(spark, sf_dir)
    out = _folder(spark, "page-stream")
    n = F.pmod(F.xxhash64("file_path", "page_no"), F.lit(1000)).cast("int")
    at = F.timestamp_seconds(F.lit(1_700_000_000) + n)
    pages = b.pages.select("file_path", F.col("page_no").cast("int").alias("page_no"), "text", at.alias("arrived_at"))
    again = pages.where("page_no = 1").withColumn("arrived_at", F.expr("arrived_at + INTERVAL 5 MINUTES"))
    # A page of no document, much later, moves the watermark past all others.
    last = spark.createDataFrame([("/elsewhere", 1, "", 1_800_000_000)], "file_path string, page_no int, text string, at long") \
        .select("file_path", "page_no", "text", F.timestamp_seconds("at").alias("arrived_at"))
    for part in (pages.where("page_no <> 1"), pages.where("page_no = 1"), again, last):
        part.coalesce(2).write.mode("append").parquet(f"{out}/pages")
    alternates = assemble_text(b.alternate_pages, MAX_PAGES, skip_empty=True)
    stream_pages(spark, f"{out}/pages", ROOT, f"{out}/runs", f"{out}/checkpoint", alternates, MAX_PAGES, max_files=2).awaitTermination()
    listed = _index(spark, sf_dir).select("file_path")
    bills = committed(spark, f"{out}/runs", "bills").join(listed, "file_path", "left_semi")
    return compare_types(bills.select("file_path", "parse_status", "text_source_reason", "text_len", "kwh_total"))


def q_rejected_lines(spark, sf_dir):
    """A progress log with broken lines between its records: the files that are done, and the lines put aside."""
    out = _folder(spark, "log")
    log = progress_log(spark, sf_dir)
    text = F.to_json(F.struct(*log.columns))
    broken = log.where("status = 'error'").select(F.concat(F.lit('{"file_path": "'), F.col("file_path")).alias("value"))
    log.select(text.alias("value")).unionByName(broken).write.text(f"{out}/progress")
    quarantine(spark, f"{out}/progress", f"{out}/rejected")
    done = done_files(read_progress(spark, f"{out}/progress")).select(F.lit("done").alias("kind"), F.col("file_path").alias("value"))
    aside = spark.read.parquet(f"{out}/rejected").select(F.lit("rejected").alias("kind"), F.col("line").alias("value"))
    return done.unionByName(aside)


def q_sorted_index(spark, sf_dir):
    """O1: every index row with its place in the sorted index."""
    return compare_types(numbered(_index(spark, sf_dir), sort_index, _folder(spark, "sorted-index")))


def q_sorted_malls(spark, sf_dir):
    """Every row of the mall rollup with its place in the sorted table."""
    malls = mall_fingerprints(_bills(spark, sf_dir), TARIFFS)
    order = [F.asc_nulls_last(k) for k in ("mall_folder", "recibos_subgroup")]
    return compare_types(numbered(malls, lambda t: t.orderBy(*order), _folder(spark, "sorted-malls")), {**_MONEY, **_RATIO})


def q_incremental_runs(spark, sf_dir):
    """Half of the files, then all with resume; the committed rows of both runs."""
    b = _src(spark, sf_dir)
    idx, out = build_index(b.listing, ROOT), _folder(spark, "incremental")
    key = F.regexp_extract("file_name", r"^(\d+)", 1).cast("long")
    incremental_parse(spark, idx.where(key % 2 == 0), b.pages, b.alternate_pages, out)
    incremental_parse(spark, idx, b.pages, b.alternate_pages, out)
    bills = committed(spark, out, "bills").select("file_path", "parse_status", "kwh_total")
    history = committed(spark, out, "history_v2").groupBy("file_path").agg(F.count(F.lit(1)).alias("history_rows"))
    return bills.join(history, "file_path", "left").na.fill(0, ["history_rows"])


def q_analysis_run(spark, sf_dir):
    """The composed run from one stored table: rows of each output."""
    out = _folder(spark, "analysis")
    _bills(spark, sf_dir).write.parquet(f"{out}/bills")
    tables = analyze(spark, spark.read.parquet(f"{out}/bills"), out, TARIFFS)
    counts = [t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("output"), "rows")
              for name, t in sorted(tables.items())]
    found = counts[0]
    for c in counts[1:]:
        found = found.unionByName(c)
    return found


QUERIES = {
    "bill_evidence": q_bill_evidence,
    "page_store_resume": q_page_store_resume,
    "compacted_runs": q_compacted_runs,
    "maintained_malls": q_maintained_malls,
    "maintained_tenants": q_maintained_tenants,
    "maintained_tariffs": q_maintained_tariffs,
    "run_table": q_run_table,
    "page_stream": q_page_stream,
    "rejected_lines": q_rejected_lines,
    "sorted_index": q_sorted_index,
    "sorted_malls": q_sorted_malls,
    "first_index_rows": q_first_index_rows,
    "tariff_map": q_tariff_map,
    "first_malls": q_first_malls,
    "meter_profile_kw": q_meter_profile_kw,
    "dataset_profile": q_dataset_profile,
    "incremental_runs": q_incremental_runs,
    "analysis_run": q_analysis_run,
    "bill_listing": q_bill_listing,
    "path_metadata": q_path_metadata,
    "bills_index": q_bills_index,
    "first_paths": q_first_paths,
    "assemble_text": q_assemble_text,
    "text_gate": q_text_gate,
    "document_gate": q_document_gate,
    "parse_bills": q_parse_bills,
    "bill_history": q_bill_history,
    "history_features": q_history_features,
    "progress_records": q_progress_records,
    "run_counters": q_run_counters,
    "mall_rollup": q_mall_rollup,
    "tariff_shares": q_tariff_shares,
    "tariff_pivot": q_tariff_pivot,
    "mall_fingerprints": q_mall_fingerprints,
    "tenant_fingerprints": q_tenant_fingerprints,
    "meter_profile": q_meter_profile,
    "tariff_value_counts": q_tariff_value_counts,
    "unique_meters": q_unique_meters,
    "kwh_describe": q_kwh_describe,
    "kwh_histogram": q_kwh_histogram,
    "row_count": q_row_count,
    "canonical_metrics": q_canonical_metrics,
    "done_files": q_done_files,
    "resume_filter": q_resume_filter,
    "incremental_parse": q_incremental_parse,
}
