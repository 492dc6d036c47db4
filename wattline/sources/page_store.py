"""Pages stored by document, so that a resumed parse reads only what it parses.

A store is a folder of Parquet tables (pages, alternate pages, listing) that
are cut into the same number of buckets by the hash of ``file_path`` and sorted
by it. Joins and the assembly of pages need no exchange of texts: the other
side, names of files, is dealt to the buckets. A short list of files also
prunes: only the buckets that can hold them are opened, and in them only the
row groups.

The tables are registered in the session's catalog when a store is opened; the
number of buckets is a part of the store.
"""
from __future__ import annotations

import json
import uuid
from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.plans.manifest import Folder

KEY = "file_path"
#: Files that are given to a scan as a list; more are joined.
LISTED = 1_000
_SPEC = "store.json"


class PageStore:
    """The tables of one store; ``pages``, ``alternate_pages`` and ``listing`` read them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        folder = Folder(spark, self.path)
        spec = json.loads(folder.read(_SPEC))
        self.buckets: int = spec["buckets"]
        self.names: dict[str, str] = {}
        for table, schema in spec["tables"].items():
            # A name of its own per opening: nothing that the catalog holds from before is met.
            self.names[table] = f"page_store_{table}_{uuid.uuid4().hex[:12]}"
            spark.sql(f"CREATE TABLE {self.names[table]} ({schema}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) "
                      f"INTO {self.buckets} BUCKETS LOCATION '{self.path}/{table}'")

    def _table(self, table: str, files: Optional[DataFrame]) -> DataFrame:
        rows = self.spark.table(self.names[table])
        if files is None:
            return rows
        # One row more than the list may hold tells whether the files fit into it.
        listed = [r[KEY] for r in files.select(KEY).where(F.col(KEY).isNotNull()).limit(LISTED + 1).collect()]
        if len(listed) <= LISTED:
            return rows.where(F.col(KEY).isin(listed) if listed else F.lit(False))
        return rows.join(files.select(KEY), KEY, "left_semi")

    def pages(self, files: Optional[DataFrame] = None) -> DataFrame:
        """All pages, or those of ``files``."""
        return self._table("pages", files)

    def alternate_pages(self, files: Optional[DataFrame] = None) -> Optional[DataFrame]:
        return self._table("alternate_pages", files) if "alternate_pages" in self.names else None

    def listing(self) -> DataFrame:
        return self._table("listing", None)

    def close(self) -> None:
        """Forget the tables in the catalog; their files stay."""
        for name in self.names.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_page_store(spark: SparkSession, path: str, pages: DataFrame, listing: DataFrame,
                     alternate_pages: Optional[DataFrame] = None, buckets: int = 64) -> PageStore:
    """Write a new store and open it; one file per bucket and table. Rows without a path are left out."""
    tables = {"pages": pages, "listing": listing} | ({"alternate_pages": alternate_pages} if alternate_pages is not None else {})
    for table, rows in tables.items():
        name = f"page_store_{table}_{uuid.uuid4().hex[:12]}"
        rows.where(F.col(KEY).isNotNull()).repartition(buckets, KEY).write.bucketBy(buckets, KEY).sortBy(KEY) \
            .option("path", f"{path.rstrip('/')}/{table}").saveAsTable(name)
        spark.sql(f"DROP TABLE {name}")
    schemas = {table: ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) for table, rows in tables.items()}
    # Last, and only whole: a store without it isn't one.
    Folder(spark, path.rstrip("/")).create(_SPEC, json.dumps({"buckets": buckets, "tables": schemas}))
    return PageStore(spark, path)
