"""Bill file listing and folder-taxonomy index.

Paths are split into segments relative to the scan root; every rule is an
array expression over those segments, so listing 10^9 paths is a narrow
projection with no shuffle until the final sort.
"""
from __future__ import annotations

import posixpath
import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BILLS_FOLDER = "7. Recibos CFE"
# The year window accepted in a folder name.
YEAR_MIN, YEAR_MAX = 1990, 2035


def _rel_parts(path: Column, root: str) -> Column:
    """Segments of ``path`` below ``root`` (the leaf file name is the last)."""
    root = root.rstrip("/")
    rel = F.when(path.startswith(root + "/"), F.substr(path, F.lit(len(root) + 2)))
    return F.split(rel, "/")


def path_predicate(path: Column, root: str, bills_folder: str = BILLS_FOLDER) -> Column:
    """The files a walk of ``root`` lists.

    Inside each ``root/<mall>`` only the subfolder named ``bills_folder`` is
    entered, and a file counts when that name is one of its directory names;
    the extension test is case-blind.
    """
    # One pattern over the whole path: as a filter, conditions on its segments would split it anew for each of them.
    folder = re.escape(bills_folder)
    root_has = bills_folder in [p for p in root.split("/") if p]
    direct = r"[^/]*(?:/[^/]*)?" if root_has else folder + "/[^/]*"
    inside = f"(?s)^{re.escape(root.rstrip('/'))}/(?:{direct}|[^/]*/{folder}/.*)\\z"
    return F.coalesce(path.rlike(r"\.[pP][dD][fF]\z") & path.rlike(inside), F.lit(False))


def bill_listing(spark: SparkSession, root: str, bills_folder: str = BILLS_FOLDER) -> DataFrame:
    """List bill PDFs under a real folder tree (``binaryFile``, paths only).

    Selecting only ``path`` makes the scan read no file content. Spark skips
    files and folders whose names start with ``_`` or ``.``. The file system
    may write paths in another form than the caller's root (with a scheme and
    host, without ``..``), so both are compared by their path part alone; the
    result starts with that part of the root. Only the bill folders are
    walked. For millions of files keep a listing table and use ``read_listing``.
    """
    plain = path_part(root)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.[pP][dD][fF]"))
    try:
        inside = bills_folder in plain.split("/")
        df = files.load(root if inside else f"{root.rstrip('/')}/{{{bills_folder},*/{bills_folder}}}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        df = files.load(root)  # no bill folder, or no root, which is an error
    return read_listing(df.select(F.regexp_replace(F.col("path"), SCHEME, "/").alias("file_path")), plain, bills_folder)


#: A URI's scheme and host up to the slash that begins its path.
SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?/"


def path_part(root: str) -> str:
    """A root without scheme and host, normalised (``.``, ``..``, repeated slashes)."""
    return posixpath.normpath(re.sub("^/+", "/", re.sub(SCHEME, "/", root)))


def read_listing(listing: DataFrame, root: str, bills_folder: str = BILLS_FOLDER,
                 path_col: str = "file_path") -> DataFrame:
    """The same listing rule over a table of paths (catalog/parquet form)."""
    return listing.where(path_predicate(F.col(path_col), root, bills_folder)).select(
        F.col(path_col).alias("file_path"))


def path_metadata(path: Column, root: str, bills_folder: str = BILLS_FOLDER):
    """(mall_folder, recibos_subgroup, recibos_year_folder, recibos_year).

    Mall = first segment below the root. After the first ``bills_folder``
    segment (leaf excluded): first segment = subgroup; year folder = first
    segment whose first ``(19|20)dd`` lies in the year window.
    """
    parts = _rel_parts(path, root)
    mall = F.get(parts, 0)
    idx = F.array_position(parts, bills_folder)       # 1-based, 0 = absent
    n_after = F.size(parts) - idx - 1
    after = F.when((idx > 0) & (n_after > 0), F.slice(parts, idx + 1, n_after)) \
        .otherwise(F.array().cast("array<string>"))
    # One pattern over the path, up to the year folder: array functions with a lambda run in interpreted code, once for
    # each of the two columns. A folder counts when its first (19|20)dd lies in the window; the leaf (no slash) is no folder.
    years = "|".join(str(y) for y in range(YEAR_MIN, YEAR_MAX + 1))
    folder = r"((?:(?!(?:19|20)\d{2})[^/])*+(" + years + r")[^/]*)/"
    below, inside = re.escape(root.rstrip("/")), re.escape(bills_folder)
    pattern = f"^{below}/(?:(?!{inside}/)[^/]*/)*+{inside}/(?:[^/]*/)*?{folder}"
    has = idx > 0
    return (
        mall.alias("mall_folder"),
        F.when(has, F.get(after, 0)).alias("recibos_subgroup"),
        F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")).alias("recibos_year_folder"),
        F.regexp_extract(path, pattern, 2).try_cast("int").alias("recibos_year"),
    )


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def build_index(listing: DataFrame, root: str, bills_folder: str = BILLS_FOLDER,
                apply_listing_rule: bool = True, sort: bool = False) -> DataFrame:
    """Listing + path metadata + file name; O1 sort when asked.

    The sort is a global range-partitioned sort; leave it off when the index
    only feeds further work (order carries no meaning in a table).
    """
    df = read_listing(listing, root, bills_folder) if apply_listing_rule else listing
    p = F.col("file_path")
    out = df.select(p, file_name(p).alias("file_name"), *path_metadata(p, root, bills_folder))
    return sort_index(out) if sort else out


def sort_index(index: DataFrame) -> DataFrame:
    """O1: by mall, subgroup, year, file name; missing last."""
    cols = [c for c in ["mall_folder", "recibos_subgroup", "recibos_year", "file_name"]
            if c in index.columns]
    return index.orderBy(*[F.asc_nulls_last(c) for c in cols])


def sort_paths(listing: DataFrame, limit: int | None = None) -> DataFrame:
    """O2/O3: case-blind path order, optionally the first ``limit`` paths."""
    out = listing.orderBy(F.lower("file_path"), "file_path")
    return out.limit(limit) if limit else out


def numbered(rows: DataFrame, sort: Callable[[DataFrame], DataFrame], path: str) -> DataFrame:
    """``rows`` in the order of ``sort``, written to ``path``, with each row's ``position`` from 1.

    The sorted parts are written once, so their order is fixed; a position is
    the row's number in its part and the rows of the parts before.
    """
    spark, number = rows.sparkSession, F.monotonically_increasing_id()
    sort(rows).select("*", F.shiftright(number, 33).alias("_part"), number.bitwiseAND((1 << 33) - 1).alias("_number")).write.parquet(path)
    parts = spark.read.parquet(path)
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    # A row per part, not per row of the table.
    before = F.coalesce(F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_part", before.alias("_before"))
    return parts.join(offsets, "_part").select(*rows.columns, (F.col("_before") + F.col("_number") + 1).alias("position"))
