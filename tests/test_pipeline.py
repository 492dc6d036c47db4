"""End-to-end properties: SQL oracle at sf0.001, one row per file, two-run
incremental = one run, stream = batch, partition-count independence."""
import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from wattline.operators.gate import assemble_text
from wattline.operators.paths import build_index
from wattline.plans import incremental
from wattline.plans.incremental import committed, current_bills, incremental_parse, read_runs
from wattline.plans.parse import bills_table, parse_bills
from wattline.sources.rendered import ROOT, render_bills
from wattline.streaming.stream import stream_parse

SF = "/root/testdata/sf0.001"
TABLES = ["nation", "customer", "orders", "lineitem"]
CHECKED = ["bills_index", "path_metadata", "text_gate", "parse_bills", "bill_history",
           "history_features", "mall_fingerprints", "tenant_fingerprints", "canonical_metrics",
           "incremental_parse", "kwh_histogram"]


def _rows(pdf):
    cols = sorted(pdf.columns)

    def norm(v):
        if v is None or (isinstance(v, float) and v != v):
            return None
        if isinstance(v, float) and v.is_integer():
            return int(v)
        return v.item() if hasattr(v, "item") else v
    return sorted((tuple(str(norm(r[c])) for c in cols) for r in pdf[cols].to_dict("records")))


@pytest.mark.parametrize("name", CHECKED)
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = E.queries()[name](spark, SF).toPandas()
    want = con.execute(E.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_one_row_per_file_any_partitioning(spark):
    b = render_bills(spark, SF)
    idx = build_index(b.listing, ROOT)
    a = bills_table(parse_bills(idx, b.pages, b.alternate_pages)).drop("parsed_at")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    c = bills_table(parse_bills(idx.repartition(5), b.pages.repartition(7),
                                b.alternate_pages)).drop("parsed_at")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert a.count() == idx.count() == a.select("file_path").distinct().count()
    assert a.exceptAll(c).count() == 0 and c.exceptAll(a).count() == 0


def test_incremental_two_runs_equal_one(spark, scratch):
    b = render_bills(spark, SF)
    idx = build_index(b.listing, ROOT)
    key = F.regexp_extract("file_name", r"^(\d+)", 1).cast("long")
    one = f"{scratch}/one"
    two = f"{scratch}/two"
    r1 = incremental_parse(spark, idx, b.pages, b.alternate_pages, one, fresh=True)
    # run 1 sees only even keys, run 2 the whole index; ok files are skipped
    incremental_parse(spark, idx.where(key % 2 == 0), b.pages, b.alternate_pages, two, fresh=True)
    r2 = incremental_parse(spark, idx, b.pages, b.alternate_pages, two)
    assert r2["skipped"] > 0
    a = current_bills(spark, one).drop("parsed_at")
    assert r1["processed"] == a.where("parse_status = 'ok'").count()

    def same(other):
        b = current_bills(spark, other).drop("parsed_at")
        assert b.count() == idx.count()
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
        for table in ("history_v2", "index"):
            h1, h2 = committed(spark, one, table), committed(spark, other, table)
            assert h1.count() == h2.count() and h1.exceptAll(h2).count() == 0
    assert read_runs(spark, two).select("file_path").distinct().count() == idx.count()
    same(two)
    # a run without resume replaces its files' rows
    incremental_parse(spark, idx.where(key % 5 == 0), b.pages, b.alternate_pages, two, resume=False)
    same(two)
    # a fresh run starts anew
    incremental_parse(spark, idx.where(key % 7 == 0), b.pages, b.alternate_pages, two, fresh=True)
    assert current_bills(spark, two).count() == idx.where(key % 7 == 0).count()


@pytest.mark.parametrize("fail_at", ["bills", "history_v2", "progress"])
def test_failure_between_tables_then_resume(spark, scratch, monkeypatch, fail_at):
    b = render_bills(spark, SF)
    idx = build_index(b.listing, ROOT)
    key = F.regexp_extract("file_name", r"^(\d+)", 1).cast("long")
    idx = idx.where(key % 6 == 0)
    incremental_parse(spark, idx, b.pages, b.alternate_pages, f"{scratch}/one")
    with monkeypatch.context() as m:
        def broken(*a, **k):
            raise RuntimeError("lost")
        m.setattr(incremental, {"bills": "bills_table", "history_v2": "history_features",
                                "progress": "progress_records"}[fail_at], broken)
        with pytest.raises(RuntimeError):
            incremental_parse(spark, idx, b.pages, b.alternate_pages, f"{scratch}/two")
    assert read_runs(spark, f"{scratch}/two").count() == 0
    incremental_parse(spark, idx, b.pages, b.alternate_pages, f"{scratch}/two")
    for table in ("bills", "history_v2"):
        x, y = (committed(spark, f"{scratch}/{d}", table).drop("parsed_at") for d in ("one", "two"))
        assert x.count() == y.count() and x.exceptAll(y).count() == 0


def test_stream_equals_batch(spark, scratch):
    b = render_bills(spark, SF)
    idx = build_index(b.listing, ROOT)
    texts = assemble_text(b.pages)
    alt = assemble_text(b.alternate_pages, skip_empty=True)
    src = f"{scratch}/texts"
    texts.write.parquet(src)
    other = "/bills/Unlisted/7. Recibos CFE/X/2024/1.pdf"
    spark.createDataFrame([(other, "short"), (None, None)], "file_path string, text string").write.mode("append").parquet(src)
    q = stream_parse(spark, src, ROOT, f"{scratch}/out", f"{scratch}/ckpt", alternate_texts=alt)
    q.awaitTermination(600)
    whole = committed(spark, f"{scratch}/out", "bills").drop("parsed_at")
    unlisted = whole.where(F.col("file_path") == other).collect()
    assert len(unlisted) == 1 and unlisted[0]["mall_folder"] == "Unlisted" and unlisted[0]["recibos_year"] == 2024
    streamed = whole.join(idx, "file_path", "left_semi")
    assert committed(spark, f"{scratch}/out", "history_v2").count() > 0
    log = read_runs(spark, f"{scratch}/out").where("file_path is not null")
    assert log.count() == whole.count()
    batch = bills_table(parse_bills(idx, b.pages, b.alternate_pages, keep_rows=False)) \
        .drop("parsed_at").where("parse_status <> 'error:FileNotFoundError'")
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0
