"""Runs: pruning before any text is read, compaction, maintained rollups, counters, rejected lines, positions."""
import json
import os

import pytest
from pyspark.sql import functions as F

from wattline.operators.fingerprints import mall_rollup, tariff_shares, tenant_fingerprints
from wattline.operators.paths import build_index, numbered, sort_index
from wattline.plans import incremental, rollup_state
from wattline.plans.incremental import (FRESH, Runs, committed, compact, done_files, incremental_parse, quarantine,
                                        read_progress, rejected_lines, rollup_counts, run_table, write_run)
from wattline.plans.manifest import read_manifest, write_manifest
from wattline.plans.parse import bills_table, parse_bills
from wattline.sources.page_store import PageStore, write_page_store
from wattline.sources.rendered import ROOT, render_bills

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bills(spark, tmp_path_factory):
    """Stored listing, pages and alternates of the rendered bills."""
    out = str(tmp_path_factory.mktemp("bills"))
    b = render_bills(spark, SF)
    for name, rows in (("listing", b.listing), ("pages", b.pages), ("alternates", b.alternate_pages)):
        rows.where(F.pmod(F.xxhash64("file_path"), F.lit(3)) == 0).write.parquet(f"{out}/{name}")
    listing, pages, alternates = (spark.read.parquet(f"{out}/{n}") for n in ("listing", "pages", "alternates"))
    return build_index(listing, ROOT), pages, alternates, listing


def _key():
    return F.regexp_extract("file_name", r"^(\d+)", 1).cast("long")


def _all(df):
    return sorted((tuple(r) for r in df.select(*sorted(set(df.columns) - {"parsed_at", "at"})).collect()), key=repr)


def _same(a, b):
    assert _all(a) == _all(b)


def _scanned(spark, since):
    """Rows that each scan of the executions after ``since`` has given out, by its node's name."""
    store = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    found = []
    executions = store.executionsList()
    for i in range(executions.size()):
        e = executions.apply(i)
        if e.executionId() <= since:
            continue
        values, graph = store.executionMetrics(e.executionId()), store.planGraph(e.executionId()).allNodes()
        for j in range(graph.size()):
            node = graph.apply(j)
            if "Scan parquet" not in node.name():
                continue
            metrics = node.metrics()
            for k in range(metrics.size()):
                m = metrics.apply(k)
                if m.name() == "number of output rows" and values.contains(m.accumulatorId()):
                    found.append((node.name(), int(values.apply(m.accumulatorId()).replace(",", ""))))
    return found


def _last_execution(spark):
    store = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    n = store.executionsList().size()
    return max((store.executionsList().apply(i).executionId() for i in range(n)), default=-1)


def test_page_store_reads_only_the_files_to_do(spark, scratch, bills):
    index, pages, alternates, listing = bills
    store = write_page_store(spark, f"{scratch}/store", pages, listing, alternates, buckets=64)
    ten = index.where(F.col("file_path").isin([r["file_path"] for r in index.orderBy("file_path").limit(10).collect()]))
    parsed = parse_bills(ten, store.pages(ten), store.alternate_pages(ten))
    before = _last_execution(spark)
    parsed.write.format("noop").mode("overwrite").save()
    read = [n for name, n in _scanned(spark, before) if "page_store_pages" in name]
    # At most ten of 64 buckets are opened.
    assert read and max(read) < pages.count() / 3
    # The pages are dealt by file already: their texts meet no exchange.
    whole = parse_bills(build_index(store.listing(), ROOT), store.pages(), None)._jdf.queryExecution()
    assert "Exchange hashpartitioning" not in whole.executedPlan().toString()
    assert "SelectedBucketsCount: 64 out of 64" in whole.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    _same(bills_table(parsed), bills_table(parse_bills(ten, pages, alternates)))
    store.close()
    again = PageStore(spark, f"{scratch}/store")
    assert again.pages().count() == pages.count() and again.pages(index.limit(0)).count() == 0
    # More files than a list may hold are joined.
    _same(again.pages(index), pages.join(index.select("file_path"), "file_path", "left_semi"))
    again.close()


def test_resume_assembles_only_the_files_to_do(spark, scratch, bills):
    index, pages, alternates, listing = bills
    store = write_page_store(spark, f"{scratch}/store", pages, listing, alternates, buckets=64)
    out = f"{scratch}/runs"
    ten = index.where("file_path is not null").orderBy("file_path").limit(10)
    names = [r["file_path"] for r in ten.collect()]
    incremental_parse(spark, index.where(~F.col("file_path").isin(names)), pages, alternates, out)
    todo = index.where(F.col("file_path").isin(names))
    before = _last_execution(spark)
    found = incremental_parse(spark, index, store.pages(todo), store.alternate_pages(todo), out)
    rows = [n for name, n in _scanned(spark, before) if "page_store_pages" in name]
    assert found["processed"] + found["errors"] >= 10 and found["skipped"] > 0
    # Ten files lie in at most ten of 64 buckets: far less than the table is read.
    assert rows and max(rows) < pages.count() / 2
    store.close()


def test_compaction(spark, scratch, bills, monkeypatch):
    index, pages, alternates, _ = bills
    out = f"{scratch}/runs"
    assert compact(spark, out) is None and read_manifest(spark, out) is None
    small = index.where(_key() % 4 == 0)
    stored = parse_bills(small, pages, alternates)
    stored.write.parquet(f"{scratch}/parsed")
    stored = spark.read.schema(stored.schema).parquet(f"{scratch}/parsed")
    parsed = bills_table(stored)
    for i in range(4):
        # Small runs; the last ones attempt files again.
        write_run(spark, stored.where(F.pmod(F.xxhash64("file_path"), F.lit(3)) == i % 3), out, f"{i:020d}-a")

    def rows():
        return {t: _all(committed(spark, out, t)) for t in ("bills", "history_v2", "index")}
    before, done = rows(), done_files(incremental.read_runs(spark, out)).count()
    assert before["bills"] == _all(parsed)
    with monkeypatch.context() as m:
        def lost(*a):
            raise RuntimeError("lost")
        m.setattr(incremental, "write_manifest", lost)
        with pytest.raises(RuntimeError):
            compact(spark, out)
    assert Runs(spark, out).base is None and rows() == before
    manifest = compact(spark, out)
    assert manifest["version"] == 1 and len(manifest["runs"]) == 4
    assert Runs(spark, out).names == [] and os.listdir(f"{out}/base") == [manifest["base"]]
    assert not [n for n in os.listdir(f"{out}/bills") if n.startswith("run=")]
    assert rows() == before and done_files(incremental.read_runs(spark, out)).count() == done
    # One base is read as it is, without a join.
    plan = committed(spark, out, "bills")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    with pytest.raises(Exception, match="exist"):
        write_manifest(spark, out, manifest)
    # Runs on top of a base: new files, repeated files; one that was started before the base's last run ends late.
    more = parse_bills(index.where(_key() % 8 < 2), pages, alternates)
    write_run(spark, more, out, f"{20:020d}-a")
    write_run(spark, stored.where(F.pmod(F.xxhash64("file_path"), F.lit(3)) == 0).withColumn("tarifa", F.lit("LATE")), out, f"{2:020d}-b")
    want = bills_table(parse_bills(index.where((_key() % 4 == 0) | (_key() % 8 < 2)), pages, alternates))
    _same(committed(spark, out, "bills"), want)
    assert compact(spark, out)["version"] == 2
    _same(committed(spark, out, "bills"), want)
    _same(rollup_state.tariffs(rollup_state.merged(rollup_counts(spark, out))),
          tariff_shares(want).select("mall_folder", "recibos_subgroup", "tarifa", "tarifa_bills"))
    # A fresh run discards the base.
    write_run(spark, stored.where(F.pmod(F.xxhash64("file_path"), F.lit(3)) == 1), out, f"{30:020d}-a{FRESH}")
    fresh = stored.where(F.pmod(F.xxhash64("file_path"), F.lit(3)) == 1)
    _same(committed(spark, out, "bills"), bills_table(fresh))
    _same(rollup_state.tariffs(rollup_state.merged(rollup_counts(spark, out))),
          tariff_shares(bills_table(fresh)).select("mall_folder", "recibos_subgroup", "tarifa", "tarifa_bills"))


def _rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def test_maintained_rollups(spark, scratch, bills):
    index, pages, alternates, _ = bills
    out = f"{scratch}/runs"
    incremental_parse(spark, index.where(_key() % 2 == 0), pages, alternates, out)
    incremental_parse(spark, index, pages, alternates, out)
    # A run that replaces files, with other values: minima, modes and medians must go back.
    changed = parse_bills(index.where(_key() % 3 == 0), pages, alternates) \
        .withColumn("kwh_total", F.when(F.col("kwh_total").isNotNull(), F.lit("1"))) \
        .withColumn("tarifa", F.lit("NEW")).withColumn("periodo_inicio", F.lit("1999-01-01"))
    run = "2" * 20 + "-changed"
    before = _last_execution(spark)
    write_run(spark, changed, out, run)
    plain = committed(spark, out, "bills")
    state = rollup_state.merged(rollup_counts(spark, out))
    _same(_rounded(rollup_state.malls(state)), _rounded(mall_rollup(plain)))
    _same(rollup_state.tariffs(state), tariff_shares(plain).select("mall_folder", "recibos_subgroup", "tarifa", "tarifa_bills"))
    _same(_rounded(rollup_state.tenants(state)), _rounded(tenant_fingerprints(plain)))
    # And back again: the changed values are gone.
    write_run(spark, parse_bills(index.where(_key() % 3 == 0), pages, alternates), out, "3" * 20 + "-back")
    compact(spark, out)
    state = rollup_state.merged(rollup_counts(spark, out))
    assert state.where("tarifa = 'NEW' or day = date'1999-01-01'").count() == 0 and state.where("n < 0").count() == 0
    plain = committed(spark, out, "bills")
    _same(_rounded(rollup_state.tenants(state)), _rounded(tenant_fingerprints(plain)))
    top = [tuple(r) for r in rollup_state.tariff_counts(state, 3).collect()]
    want = plain.where("tarifa is not null").groupBy("tarifa").count().orderBy(F.desc("count"), "tarifa").limit(3).collect()
    assert top == [tuple(r) for r in want] and before >= -1


def test_only_runs_with_replaced_files_are_read(spark, scratch, bills):
    index, pages, alternates, _ = bills
    out = f"{scratch}/runs"
    parsed = parse_bills(index.where(_key() % 5 < 3), pages, alternates)
    parsed.write.parquet(f"{scratch}/parsed")
    stored = spark.read.schema(parsed.schema).parquet(f"{scratch}/parsed")
    key = F.regexp_extract("file_name", r"^(\d+)", 1).cast("long") % 5
    for i in range(3):
        write_run(spark, stored.where(key == i), out, f"{i:020d}-a")
    files = stored.where(key == 1).select("file_path")
    old, beaten = incremental.replaced_bills(spark, out, "9", files)
    assert beaten is None
    read = {p for p in old.inputFiles()}
    assert any("run=" + f"{1:020d}-a" in p and "/bills/" in p for p in read)
    assert not any("/bills/" in p and f"{i:020d}-a" in p for p in read for i in (0, 2))
    assert old.count() == files.count()
    assert incremental.replaced_bills(spark, out, "9", index.where(_key() % 5 == 4).select("file_path")) == (None, None)


def test_counters(spark, scratch, bills):
    index, pages, alternates, _ = bills
    out = f"{scratch}/runs"
    first = incremental_parse(spark, index.where(_key() % 2 == 0), pages, alternates, out)
    second = incremental_parse(spark, index, pages, alternates, out)
    rows = [r.asDict() for r in run_table(spark, out).orderBy("run").collect()]
    assert [{k: r[k] for k in ("processed", "errors", "skipped")} for r in rows] == [first, second]
    assert first["skipped"] == 0 and second["skipped"] == first["processed"]
    assert sum(second.values()) == index.count()
    assert run_table(spark, f"{scratch}/none").count() == 0


def test_rejected_lines(spark, scratch):
    path = f"{scratch}/log.jsonl"
    good = {"file_path": "/a.pdf", "status": "ok"}
    with open(path, "w") as f:
        f.write("\n".join([json.dumps(good), "", '{"file_path": "/b.pdf", "sta', "   ", "not json", json.dumps({**good, "file_path": "/c.pdf"})]))
    assert {r["file_path"] for r in done_files(read_progress(spark, path)).collect()} == {"/a.pdf", "/c.pdf"}
    rejected = rejected_lines(spark, path).collect()
    assert {r["line"] for r in rejected} == {'{"file_path": "/b.pdf", "sta', "not json"}
    assert all(r["file"].endswith("log.jsonl") and r["start"] == 0 for r in rejected)
    assert quarantine(spark, path, f"{scratch}/rejected") == 2 and quarantine(spark, path, f"{scratch}/rejected") == 2
    assert spark.read.parquet(f"{scratch}/rejected").count() == 4
    assert rejected_lines(spark, f"{scratch}/missing.jsonl").count() == 0
    with open(f"{scratch}/bills.csv", "w") as f:
        f.write("a,b\n1,2\n3\n4,5,6\n7,8\n")
    schema = incremental.T.StructType.fromDDL("a string, b string")
    assert {r["line"] for r in rejected_lines(spark, f"{scratch}/bills.csv", schema, "csv").collect()} == {"3", "4,5,6"}


def test_positions(spark, scratch, bills):
    index = bills[0]
    got = numbered(index.repartition(7), sort_index, f"{scratch}/sorted").orderBy("position").collect()
    want = sort_index(index).collect()
    assert [r["position"] for r in got] == list(range(1, len(want) + 1))
    keys = ("mall_folder", "recibos_subgroup", "recibos_year", "file_name")
    assert [tuple(r[k] for k in keys) for r in got] == [tuple(r[k] for k in keys) for r in want]
    assert numbered(index.limit(0), sort_index, f"{scratch}/none").count() == 0
