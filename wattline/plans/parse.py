"""Files + page texts -> parsed bills and history rows.

One lazy plan per call: page assembly (shuffle by ``file_path``), gate,
alternate-text join (co-partitioned with the assembly), one wide projection
for all fields, then the join with the index. The text column is dropped
right after extraction, so nothing wide reaches a sort, a later shuffle, a
cache or a write.
Every listed file gives exactly one row: problems become ``parse_status``
values (``error:<Type>``), never a failed task.
"""
from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.operators.extract import (
    DEFAULT_SPECS, FIELD_COLUMNS, FieldSpec, extract_fields, history_row_fields,
    history_row_groups,
)
from wattline.operators.gate import assemble_text, choose_text_source, text_gate
from wattline.operators.paths import file_name, path_metadata
from wattline.session import where_computed

INDEX_COLUMNS = ["file_path", "file_name", "mall_folder", "recibos_subgroup",
                 "recibos_year_folder", "recibos_year"]
ENVELOPE_COLUMNS = ["parse_status", "parse_error", "text_len", "embedded_text_len",
                    "used_ocr", "text_source", "text_source_reason", "extracted_pages",
                    "parsed_at"]
ID_COLUMNS = ["no_servicio", "cuenta", "rmu", "rpu", "medidor"]
# Column order of the flat bills table (parsed_at last).
BILL_COLUMNS = [c for c in FIELD_COLUMNS if c != "historico_rows"] + INDEX_COLUMNS + [
    "parse_status", "parse_error", "text_len", "embedded_text_len", "used_ocr",
    "text_source", "text_source_reason", "extracted_pages"]


def parse_bills(index: DataFrame, pages: DataFrame,
                alternate_pages: Optional[DataFrame] = None, max_pages: int = 2,
                min_chars: int = 80, specs: Sequence[FieldSpec] = DEFAULT_SPECS,
                keep_rows: bool = True, prune: bool = False, evidence: bool = False) -> DataFrame:
    """Parsed bill table (one row per index row) with the envelope.

    ``keep_rows`` keeps the ``historico_rows`` array for ``bill_history``.
    ``prune`` leaves out the pages of files that aren't in the index before any
    text is assembled: for an index of few files of a large page table.
    ``evidence`` adds where in the assembled text each field was read.
    """
    if prune:
        pages = pages_of(pages, index)
        alternate_pages = None if alternate_pages is None else pages_of(alternate_pages, index)
    emb = assemble_text(pages, max_pages)
    alt = None
    if alternate_pages is not None:
        # Both assemblies are exchanged by file, so their join needs no more exchange. Leaving out the
        # alternates of other files before would run assembly and gate of all texts a second time;
        # which alternates count is the choice's own rule.
        alt = assemble_text(alternate_pages, max_pages, skip_empty=True)
    return parse_texts(index, emb, alt, max_pages, min_chars, specs, keep_rows, evidence=evidence)


def pages_of(pages: DataFrame, files: DataFrame, key: str = "file_path") -> DataFrame:
    """The pages of the given files. The join and the assembly share one exchange by ``key``; few files are broadcast by AQE."""
    return pages.join(files.select(key), key, "left_semi")


def parse_texts(index: Optional[DataFrame], texts: DataFrame, alternate_texts: Optional[DataFrame] = None,
                max_pages: int = 2, min_chars: int = 80,
                specs: Sequence[FieldSpec] = DEFAULT_SPECS, keep_rows: bool = True,
                root: Optional[str] = None, evidence: bool = False) -> DataFrame:
    """Parse from assembled texts (``file_path``, ``text``).

    Batch: every index row gives one output row (a file without text is an
    error row). With a ``root`` instead of an index (a stream of arriving
    documents) every text gives one row, whose index columns come from its
    own path. A missing text counts as empty.
    """
    texts = texts.withColumn("text", F.coalesce(F.col("text"), F.lit("")))
    gated = text_gate(texts, "text", min_chars, lengths=True)
    alt = None
    if alternate_texts is not None:
        alt = alternate_texts.withColumnRenamed("text", "alt_text")
    chosen = choose_text_source(gated, alt)
    # Extract before the index join: the join then moves only short fields,
    # and the wide text never reaches a sort or a second exchange.
    carried = ["file_path", "gate_reason", "embedded_text_len", "used_ocr", "text_source",
               "text_len"]
    ex = extract_fields(chosen.withColumn("text", F.when(F.col("text_len") > 0, F.col("text"))),
                        "text", specs, keep=carried, evidence=evidence).withColumn("_found", F.lit(True))
    if root is not None:
        path = F.col("file_path")
        j = ex.select("*", file_name(path).alias("file_name"), *path_metadata(path, root))
    else:
        j = index.select(*INDEX_COLUMNS).join(ex, "file_path", "left")
    found = F.col("_found").isNotNull()
    empty = found & (F.col("text_len") == 0)
    is_ok = found & ~empty
    fields = []
    for c in FIELD_COLUMNS:
        if c == "historico_count":
            fields.append(F.when(is_ok, F.col(c)).otherwise(F.lit(0)).alias(c))
        elif c == "historico_rows":
            if keep_rows:
                fields.append(F.when(is_ok, F.col(c)).alias(c))
        else:
            fields.append(F.when(is_ok, F.col(c)).alias(c))
    return j.select(
        *fields,
        *INDEX_COLUMNS,
        F.when(~found, F.lit("error:FileNotFoundError"))
         .when(empty, F.lit("error:ValueError")).otherwise(F.lit("ok")).alias("parse_status"),
        F.when(~found, F.col("file_path"))
         .when(empty, F.lit("empty_text_after_ocr")).otherwise(F.lit("")).alias("parse_error"),
        F.coalesce(F.col("text_len"), F.lit(0)).cast("int").alias("text_len"),
        F.coalesce(F.col("embedded_text_len"), F.lit(0)).cast("int").alias("embedded_text_len"),
        F.coalesce(F.col("used_ocr"), F.lit(False)).alias("used_ocr"),
        F.coalesce(F.col("text_source"), F.lit("pdfplumber")).alias("text_source"),
        F.coalesce(F.col("gate_reason"), F.lit("init")).alias("text_source_reason"),
        F.lit(max_pages).cast("int").alias("extracted_pages"),
        F.current_timestamp().alias("parsed_at"),
        *([F.when(is_ok, F.col("evidence")).alias("evidence")] if evidence else []),
    )


def bills_table(parsed: DataFrame) -> DataFrame:
    """The flat ``bills_parsed`` table (history array dropped)."""
    return parsed.drop("historico_rows") if "historico_rows" in parsed.columns else parsed


HISTORY_CONTEXT = INDEX_COLUMNS + ["no_servicio", "cuenta", "tarifa"]


def bill_history(parsed: DataFrame) -> DataFrame:
    """One row per history entry of an ``ok`` bill, with its context.

    ``historico_idx`` is the entry's 0-based position in the bill.
    """
    # The outer form, for files that have rows: for the other one Spark infers a filter on the rows,
    # pushes it to where they are read from the text and reads them again for it.
    rows = where_computed(parsed, (F.col("parse_status") == "ok") & (F.col("historico_count") > 0) & (F.size("historico_rows") > 0))
    each = rows.select(*HISTORY_CONTEXT, F.posexplode_outer("historico_rows").alias("historico_idx", "_m"))
    groups = history_row_groups(each.withColumn("historico_idx", F.col("historico_idx").cast("int")), "_m", [*HISTORY_CONTEXT, "historico_idx"])
    return groups.select(*HISTORY_CONTEXT, "historico_idx", *history_row_fields())


def progress_records(parsed: DataFrame) -> DataFrame:
    """S5 record per attempted file (ok or error), ready to append."""
    return parsed.select(
        "file_path",
        F.when(F.col("parse_status") == "ok", F.lit("ok")).otherwise(F.lit("error")).alias("status"),
        "used_ocr", "text_source",
        F.col("text_source_reason").alias("reason"),
        F.date_format("parsed_at", "yyyy-MM-dd'T'HH:mm:ss").alias("at"),
        F.nullif(F.col("parse_error"), F.lit("")).alias("error"),
    )


def counters() -> list:
    """Processed / errors of a parse, to aggregate or to observe."""
    return [F.count_if(F.col("parse_status") == "ok").alias("processed"),
            F.count_if(F.col("parse_status") != "ok").alias("errors")]


def run_counters(parsed: DataFrame) -> DataFrame:
    """Processed / errors (skipped comes from the resume filter)."""
    return parsed.agg(*counters(), F.count(F.lit(1)).alias("attempted"))
