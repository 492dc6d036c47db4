"""Operator 7: exact dedup by deterministic block naming (native).

Each text, lower-cased A-Z only, is cut into blocks of ``BLOCK`` characters.
Equal blocks meet in a bucket and are sorted there; a block's integer name is
its rank among the different blocks of its bucket. Then pairs of adjacent names
are named by integers in the same way, level by level, until each document has
one name. Names compare whole blocks and whole pairs, never hashes of them, so
two documents share an identity only if their texts are equal.

Skew: blocks that fill more than 1/``HOT_SHARE`` of all block rows (so at most
``HOT_SHARE`` of them, each of bounded size) get their names from a broadcast
table and their rows spread evenly. Pairs are reduced to different pairs before
the shuffle, and their names joined back (adaptive skew join).

Nulls: a null text counts as empty; all empty texts are one group. A null
doc_id orders before every other id. Of rows that repeat a doc_id within a
group exactly one is kept. An empty table gives an empty result.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from wattline.llm.common import row_mark, stored, temporaries, text_or_empty

#: Characters in a block.
BLOCK = 4096
#: A block is hot if it fills more than this part of all block rows.
HOT_SHARE = 512
#: Fewer rows than this never make a block hot.
LEAST_HOT = 50
#: Buckets in which blocks are sorted (a fixed number of name prefixes).
BUCKETS = 1 << 20
#: Names of hot blocks start here, above all bucketed names.
HOT_BASE = 1 << 62

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(col: str):
    return F.translate(text_or_empty(col), UPPER, LOWER)


def _blocks(docs: DataFrame, key: str, text: str, block: int) -> DataFrame:
    """(row, head, n, idx, block, digest): whole texts cut into blocks; the first one carries the row's head."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("doc_id"),
                       row_mark(key, text).alias("mark"), normalised(text).alias("norm"))
    rows = rows.select("row", F.struct("doc_id", "mark", F.unhex(F.sha2("norm", 256)).alias("sha")).alias("head"),
                       F.regexp_extract_all("norm", F.lit("(?s).{1,%d}" % block), F.lit(0)).alias("blocks"))
    rows = rows.select("row", "head", F.greatest(F.size("blocks"), F.lit(1)).alias("n"),
                       F.posexplode_outer("blocks").alias("idx", "block"))
    first = F.coalesce(F.col("idx"), F.lit(0)) == 0
    return rows.select("row", F.when(first, F.col("head")).alias("head"), "n", F.coalesce("idx", F.lit(0)).alias("idx"), F.coalesce("block", F.lit("")).alias("block")) \
        .withColumn("digest", F.xxhash64("block"))


def name_blocks(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """(row, head, n, idx, name): the blocks of every document, named."""
    blocks = _blocks(docs, key, text, block)
    counts = stored(blocks.groupBy("digest").agg(F.count("*").alias("rows")), "block-counts")
    limit = (counts.agg(F.sum("rows")).first()[0] or 0) // HOT_SHARE
    hot_digests = counts.where(F.col("rows") > F.lit(max(limit, LEAST_HOT))).select("digest")
    # One block stands for its digest; another block with that digest isn't
    # hot and is sorted as usual, so equal digests never merge two texts.
    hot = blocks.join(F.broadcast(hot_digests), "digest", "left_semi") \
        .groupBy("digest").agg(F.min("block").alias("hot_block"))
    hot = stored(hot.withColumn("hot_name", F.lit(HOT_BASE) + F.row_number().over(Window.orderBy("hot_block"))),
                 "hot-blocks")
    rows = blocks.join(F.broadcast(hot), "digest", "left")
    is_hot = F.coalesce(F.col("block") == F.col("hot_block"), F.lit(False))
    rows = rows.select(
        "row", "head", "n", "idx", F.when(is_hot, F.col("hot_name")).alias("hot_name"),
        F.when(~is_hot, F.col("block")).alias("block"),
        F.pmod(F.when(is_hot, F.xxhash64("row", "idx")).otherwise(F.col("digest")), F.lit(BUCKETS)).alias("bucket"))
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy("block"))
    return stored(rows.select("row", "head", "n", "idx", F.coalesce(
        "hot_name", F.shiftleft(F.col("bucket"), 42) + rank).alias("name")), "named-blocks")


def _name_pairs(pairs: DataFrame) -> DataFrame:
    """Integer names of the different pairs; sorted, so that a rerun names alike."""
    names = pairs.where("right is not null").select("left", "right").distinct() \
        .sortWithinPartitions("left", "right").withColumn("name", F.monotonically_increasing_id())
    return stored(names, "pair-names")


def identities(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """(row, head, n, name): equal (n, name) if and only if the texts are equal."""
    named = name_blocks(docs, key, text, block)
    done = named.where("n = 1").select("row", "head", "n", "name")
    longest = named.agg(F.max("n")).first()[0] or 0
    current = named.where("n > 1").select("row", "n", "idx", "name", F.col("n").alias("left_over"))
    whole = None
    while longest > 1:
        half = F.shiftright("idx", 1)
        pairs = current.groupBy("row", "n", "left_over", half.alias("idx")).agg(
            F.max(F.when(F.col("idx") % 2 == 0, F.col("name"))).alias("left"),
            F.max(F.when(F.col("idx") % 2 == 1, F.col("name"))).alias("right"))
        pairs = stored(pairs, "pairs")
        level = pairs.join(_name_pairs(pairs), ["left", "right"], "left").select(
            "row", "n", "idx", F.when(F.col("right").isNull(), F.col("left")).otherwise(F.col("name")).alias("name"),
            F.shiftright(F.col("left_over") + 1, 1).alias("left_over"))
        level = stored(level, "level")
        ready = level.where("left_over = 1").select("row", "n", "name")
        whole = ready if whole is None else whole.unionByName(ready)
        current = level.where("left_over > 1")
        longest = (longest + 1) // 2
    if whole is None:
        return done
    heads = named.where("n > 1 and idx = 0").select("row", "head")
    return done.unionByName(heads.join(whole, "row").select("row", "head", "n", "name"))


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, mark (see ``row_mark``)."""
    with temporaries(docs.sparkSession) as keep:
        ids = keep(identities(docs, key, text, block), "identities")
    ids = ids.select("row", "head.*", "n", "name")
    last = F.max(F.struct("doc_id", "row"))
    groups = stored(ids.groupBy("n", "name").agg(last.alias("keep"), F.count("*").alias("group_size")), "groups")
    return ids.join(groups, ["n", "name"]).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), "mark")
