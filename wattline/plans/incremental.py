"""Tables on storage and the resumable batch run.

The reference resumes by skipping files whose progress log holds an ``ok``
record. Here each run writes its tables into folders named by the run, and the
progress records last: they are the run's commit. Readers take only the runs
that have progress records, so a run that failed half-way leaves nothing that
anyone reads, and the next run parses its files again. ``compact`` merges runs
into one base; the manifest says which runs a base holds. The skip is an anti
join (a broadcast only when AQE measures the done set as small). Outputs go to
a folder the caller names (on a cluster: shared storage); one writer at a time
adds runs to it.
"""
from __future__ import annotations

import time
import uuid
from typing import Any, Optional

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.operators.fingerprints import normalize_columns
from wattline.operators.history import history_features
from wattline.operators.paths import sort_index
from wattline.plans.manifest import Folder, read_manifest, write_manifest
from wattline.plans.parse import INDEX_COLUMNS, bill_history, bills_table, counters, parse_bills, progress_records
from wattline.plans.rollup_state import merged, signed_counts

PROGRESS_SCHEMA = T.StructType([
    T.StructField("file_path", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("used_ocr", T.BooleanType()),
    T.StructField("text_source", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("at", T.StringType()),
    T.StructField("error", T.StringType()),
])
RUN_SCHEMA = T.StructType(PROGRESS_SCHEMA.fields + [T.StructField("run", T.StringType())])
#: The column of a line that isn't a record.
REJECTED = "_rejected"


def _json(spark: SparkSession, schema: T.StructType, paths: str | list[str], **options: str) -> DataFrame:
    """JSON lines, none if there is no such path."""
    try:
        return spark.read.schema(schema).options(**options).json(paths)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """S6 input: JSON-lines progress log; blank or malformed lines are left out (see ``rejected_lines``), a missing log is empty."""
    return _json(spark, PROGRESS_SCHEMA, path, mode="DROPMALFORMED")


def rejected_lines(spark: SparkSession, path: str, schema: T.StructType = PROGRESS_SCHEMA, fmt: str = "json") -> DataFrame:
    """(file, start, line): the lines of a log or a CSV table that aren't records of ``schema``, as they are.

    ``start`` is the first byte of the part of the file that the line was found
    in. Blank lines are no records and aren't rejected; nor is a CSV table's
    header, a line of the column names.
    """
    whole = T.StructType(schema.fields + [T.StructField(REJECTED, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED}
    try:
        lines = spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "file string, start long, line string")
    if fmt == "json":
        read, record = F.from_json("value", whole, options), F.trim("value") != ""
    else:
        read = F.from_csv("value", whole.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)
        record = (F.trim("value") != "") & (F.translate("value", " \"", "") != ",".join(schema.fieldNames()))
    return lines.where(record).select("_metadata.file_path", "_metadata.file_block_start", "value", read[REJECTED].alias("rejected")) \
        .where("rejected is not null").select(F.col("file_path").alias("file"), F.col("file_block_start").alias("start"), F.col("value").alias("line"))


def quarantine(spark: SparkSession, path: str, table: str, schema: T.StructType = PROGRESS_SCHEMA, fmt: str = "json") -> int:
    """Add the rejected lines of a log to a quarantine table; returns how many there were."""
    seen = Observation()
    rejected_lines(spark, path, schema, fmt).observe(seen, F.count(F.lit(1)).alias("lines")).write.mode("append").parquet(table)
    return seen.get["lines"]


def done_files(progress: DataFrame) -> DataFrame:
    """Paths with any ``ok`` record (a later error does not undo it)."""
    return (progress.where((F.col("status") == "ok") & F.col("file_path").isNotNull()
                           & (F.col("file_path") != ""))
            .select("file_path").distinct())


def resume_filter(index: DataFrame, progress: DataFrame) -> DataFrame:
    """Index rows not yet done."""
    return index.join(done_files(progress), "file_path", "left_anti")


def read_bills_csv(spark: SparkSession, path: str, schema: Optional[T.StructType] = None):
    """S3: parsed-bills CSV with header; names stripped; explicit schema keeps
    identifiers as text (no lost leading zeros)."""
    r = spark.read.option("header", True)
    df = r.schema(schema).csv(path) if schema is not None else \
        r.option("inferSchema", False).csv(path)
    return normalize_columns(df)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                partition_by: Optional[list] = None) -> None:
    """Write a table (parquet by default; CSV with header on request)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


#: The end of a fresh run's name.
FRESH = "-fresh"
#: The tables of a run besides its progress records.
TABLES = ("index", "parsed", "bills", "history_v2", "rollup_counts")


def write_run(spark: SparkSession, parsed: DataFrame, out_dir: str, run: str) -> dict[str, int]:
    """Write one run's tables, the progress records last; returns the run's counters.

    The parse is written once and every other table is derived from that copy,
    so the text work runs once and the lineage is cut there; the counters are
    observed while it is written. ``rollup_counts`` holds what the run adds to
    the maintained rollups, less what it replaces. Writing the same run again
    replaces it.
    """
    path, seen = f"{out_dir}/parsed/run={run}", Observation()
    parsed.observe(seen, *counters()).write.mode("overwrite").parquet(path)
    stored = spark.read.schema(parsed.schema).parquet(path)
    write_table(sort_index(stored.select(*INDEX_COLUMNS)), f"{out_dir}/index/run={run}")
    write_table(bills_table(stored), f"{out_dir}/bills/run={run}")
    write_table(history_features(bill_history(stored)), f"{out_dir}/history_v2/run={run}")
    old, beaten = (None, None) if run.endswith(FRESH) else replaced_bills(spark, out_dir, run, stored.select("file_path"))
    counted = bills_table(stored) if beaten is None else bills_table(stored).join(beaten, "file_path", "left_anti")
    change = signed_counts(counted, F.lit(1))
    write_table(change if old is None else change.unionByName(signed_counts(old, F.lit(-1))), f"{out_dir}/rollup_counts/run={run}")
    progress_records(stored).write.mode("overwrite").json(f"{out_dir}/progress/run={run}")
    return seen.get


def write_counters(spark: SparkSession, out_dir: str, run: str, counted: dict[str, int]) -> None:
    """The counters of a committed run, as a row of the table ``runs``."""
    row = spark.createDataFrame([(counted["processed"], counted["errors"], counted["skipped"])],
                                "processed long, errors long, skipped long")
    row.coalesce(1).write.mode("overwrite").json(f"{out_dir}/runs/run={run}")


def run_table(spark: SparkSession, out_dir: str) -> DataFrame:
    """Run, processed, errors and skipped of each run."""
    return _json(spark, T.StructType.fromDDL("processed long, errors long, skipped long, run string"),
                 f"{out_dir}/runs", basePath=f"{out_dir}/runs")


class Runs:
    """What counts in a folder of runs: the base of its manifest and the runs that no base holds yet.

    Reading the folder names and the manifest takes the driver a listing; rows are read by Spark.
    """

    def __init__(self, spark: SparkSession, out_dir: str, without: str = ""):
        self.spark, self.out_dir = spark, out_dir
        manifest = read_manifest(spark, out_dir) or {"version": 0, "base": None, "runs": [], "since": ""}
        self.version, self.base = manifest["version"], manifest["base"]
        held, folder = set(manifest["runs"]), Folder(spark, out_dir)
        names = [n.removeprefix("run=") for n in folder.names("progress") if n.startswith("run=")]
        committed_runs = [n for n in names if n not in held and n != without and "_SUCCESS" in folder.names(f"progress/run={n}")]
        #: The last fresh run: nothing before it counts.
        self.since = max([manifest["since"], *[n for n in committed_runs if n.endswith(FRESH)]])
        self.names = [n for n in committed_runs if n >= self.since]

    def table(self, name: str, runs: Optional[list[str]] = None) -> Optional[DataFrame]:
        """Rows of a table in the given runs, all that no base holds by default, with their ``run``; None if there are none."""
        paths = [f"{self.out_dir}/{name}/run={r}" for r in (self.names if runs is None else runs)]
        if not paths:
            return None
        rows = self.spark.read.option("basePath", f"{self.out_dir}/{name}")
        rows = rows.schema(RUN_SCHEMA).option("mode", "DROPMALFORMED").json(paths) if name == "progress" else rows.parquet(*paths)
        return rows.withColumn("run", F.col("run").cast("string"))

    def base_table(self, name: str) -> Optional[DataFrame]:
        """Rows of a table of the base that no later fresh run has discarded, with the run they came from."""
        if self.base is None:
            return None
        return self.spark.read.parquet(f"{self.out_dir}/base/{self.base}/{name}").where(F.col("run") >= self.since)

    def progress(self) -> DataFrame:
        """Progress records of everything that counts, with their ``run``."""
        parts = [t.select(*RUN_SCHEMA.fieldNames()) for t in (self.base_table("progress"), self.table("progress")) if t is not None]
        return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0] if parts else self.spark.createDataFrame([], RUN_SCHEMA)

    def attempts(self) -> Optional[DataFrame]:
        """(file_path, run): the latest attempt of each file in the runs that no base holds."""
        records = self.table("progress")
        return None if records is None else records.groupBy("file_path").agg(F.max("run").alias("run"))

    def rows(self, name: str) -> DataFrame:
        """The rows of a table that count, each file's latest attempt, with their ``run``.

        A base holds one attempt of a file, so only files that were attempted
        since are looked up in it: a base without later runs is read as it is.
        """
        base, latest = self.base_table(name), self.attempts()
        if latest is None:
            if base is None:
                raise FileNotFoundError(f"no committed run in {self.out_dir}")
            return base
        rows = self.table(name).join(latest, ["file_path", "run"], "left_semi")
        if base is None:
            return rows
        later = latest.withColumnRenamed("run", "later")
        newer = (F.col("base.file_path") == F.col("new.file_path")) & (F.col("new.later") > F.col("base.run"))
        kept = base.alias("base").join(later.alias("new"), newer, "left_anti")
        # A run that was started before one that the base holds may have ended after it.
        held = self.base_table("progress").groupBy("file_path").agg(F.max("run").alias("run"))
        beaten = held.join(later, "file_path").where(F.col("run") > F.col("later")).select("file_path")
        return kept.unionByName(rows.join(beaten, "file_path", "left_anti").select(*kept.columns))


def read_runs(spark: SparkSession, out_dir: str) -> DataFrame:
    """Progress records from the last fresh run on, with their ``run``; none if there is no log yet."""
    return Runs(spark, out_dir).progress()


def committed(spark: SparkSession, out_dir: str, table: str) -> DataFrame:
    """The rows of a stored table that count: of committed runs, each file's latest attempt.

    Runs are named in the order of their start, and a run attempts a file once.
    """
    return Runs(spark, out_dir).rows(table).drop("run")


def rollup_counts(spark: SparkSession, out_dir: str) -> DataFrame:
    """The signed counts (``plans.rollup_state``) of everything that counts: what every run added and retracted."""
    runs = Runs(spark, out_dir)
    parts = [t.drop("run") for t in (runs.base_table("rollup_counts"), runs.table("rollup_counts")) if t is not None]
    if not parts:
        raise FileNotFoundError(f"no committed run in {out_dir}")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def replaced_bills(spark: SparkSession, out_dir: str, run: str, files: DataFrame) -> tuple[Optional[DataFrame], Optional[DataFrame]]:
    """The bills that count now and that ``run`` replaces by attempting ``files`` again, and the files of which a later run counts.

    Each is None if there are none. Only the runs (or the base) that hold a
    replaced bill are read.
    """
    runs = Runs(spark, out_dir, without=run)
    attempts = runs.progress().groupBy("file_path").agg(F.max("run").alias("run")).join(files, "file_path", "left_semi")
    found = [r["run"] for r in attempts.select("run").distinct().collect()]
    beaten = attempts.where(F.col("run") > run).select("file_path") if any(r > run for r in found) else None
    before = [r for r in found if r < run]
    if not before:
        return None, beaten
    parts = []
    if outside := [r for r in before if r in runs.names]:
        parts.append(runs.table("bills", outside))
    if len(outside) < len(before):
        parts.append(runs.base_table("bills").where(F.col("run").isin(*[r for r in before if r not in outside])))
    columns = parts[0].columns
    old = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1].select(*columns))
    return old.join(attempts.where(F.col("run") < run), ["file_path", "run"], "left_semi").drop("run"), beaten


def incremental_parse(spark: SparkSession, index: DataFrame, pages: DataFrame,
                      alternate_pages: Optional[DataFrame], out_dir: str,
                      resume: bool = True, fresh: bool = False, max_pages: int = 2) -> dict[str, int]:
    """Parse what is not yet ``ok`` and add it to the stored tables.

    Layout under ``out_dir``: ``index/`` (sorted), ``parsed/`` (with the history
    array), ``bills/``, ``history_v2/``, ``rollup_counts/``, ``progress/`` and
    ``runs/``, each by run; read them with ``committed``. With ``resume`` files
    that are done are skipped: only the pages of the others are assembled.
    Without it all files are parsed again, and their new rows replace the old
    ones. ``fresh`` also discards what earlier runs found: readers start at it.
    Returns the run counters (processed / errors / skipped).
    """
    run = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}" + (FRESH if fresh else "")
    todo, prune = index, False
    if resume and not fresh:
        done = done_files(read_runs(spark, out_dir))
        todo, prune = index.join(done, "file_path", "left_anti"), not done.isEmpty()
    counted = write_run(spark, parse_bills(todo, pages, alternate_pages, max_pages, prune=prune), out_dir, run)
    skipped = index.count() - counted["processed"] - counted["errors"] if prune else 0
    found = {"processed": counted["processed"], "errors": counted["errors"], "skipped": skipped}
    write_counters(spark, out_dir, run, found)
    return found


def current_bills(spark: SparkSession, out_dir: str) -> DataFrame:
    """The latest committed attempt per file."""
    return committed(spark, out_dir, "bills")


def _kept_records(progress: DataFrame) -> DataFrame:
    """Of each file's records the latest, and the latest ``ok`` one if that is another: all that resuming and reading need."""
    record = F.struct("run", "at", *[c for c in progress.columns if c not in ("run", "at", "file_path")])
    ok: Column = F.when(F.col("status") == "ok", record)
    both = progress.groupBy("file_path").agg(F.max(record).alias("last"), F.max(ok).alias("ok"))
    each = F.array_distinct(F.array_compact(F.array("last", "ok")))
    return both.select("file_path", F.explode(each).alias("r")).select("file_path", "r.*")


def compact(spark: SparkSession, out_dir: str) -> Optional[dict[str, Any]]:
    """Merge the base and all committed runs into a new base; returns the manifest, or None if there is nothing to merge.

    The new base is written beside the old one, then the manifest is replaced,
    and only then are the runs and the old base removed: readers see the same
    rows before and after, and a compaction that fails on the way changes
    nothing. A reader that opened its tables before must be done before the
    next compaction. Runs that were committed meanwhile stay as they are.
    """
    runs = Runs(spark, out_dir)
    if not runs.names:
        return None
    base = f"{runs.version + 1:012d}-{uuid.uuid4().hex[:8]}"
    for name in TABLES:
        if name == "rollup_counts":
            # One state from the last fresh run on; it bears the name of the last run.
            rows = merged(rollup_counts(spark, out_dir)).withColumn("run", F.lit(runs.names[-1]))
        else:
            rows = runs.rows(name)
        (sort_index(rows) if name == "index" else rows).write.parquet(f"{out_dir}/base/{base}/{name}")
    _kept_records(runs.progress()).write.parquet(f"{out_dir}/base/{base}/progress")
    folder = Folder(spark, out_dir)
    present = [n.removeprefix("run=") for n in folder.names("progress") if n.startswith("run=")]
    # Committed runs before the last fresh one hold nothing that counts; the base stands for them as well.
    held = [n for n in present if n in runs.names or n < runs.since]
    manifest = {"version": runs.version + 1, "base": base, "runs": held, "since": runs.since}
    write_manifest(spark, out_dir, manifest)
    for n in held:
        for name in (*TABLES, "progress"):
            folder.delete(f"{name}/run={n}")
    # The base before, and what compactions that failed have left.
    for n in folder.names("base"):
        if n != base:
            folder.delete(f"base/{n}")
    return manifest
