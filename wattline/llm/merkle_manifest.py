"""Operator 11: Merkle dataset manifest with incremental witnesses.

Every row is a leaf, the SHA-256 of its columns. The leaves of a language,
ordered by doc_id, are hashed in runs of two, level by level, until one node is
left, the language's subroot; the last run of a level may be one node, which is
hashed alone. The subroots, ordered by language, give the root in the same way.

A tree grows by aligned appends (``append_all``): a new node opens a subtree of
its own; two neighbouring subtrees of equal height that are complete close to
one, and each leaf's witness gets the root of the other half. What is open at
the end closes level by level. So a witness is extended only when a sibling is
completed, and is never computed again.

On the cluster the leaves are appended in aligned blocks of 2**``HEIGHT``, each
in one task. The roots of the blocks are further appends to the same tree, in
blocks of the next tier, until each language has one node; then the languages
are appended to the last tree. A leaf's proof is its witness in its block and
its blocks' witnesses, tier by tier: each tier is a 2**HEIGHT-th of the one
below, and is joined to it on (language, block).

Places come from a range-partitioned sort and counts by partition, so a
language that holds any share of the rows spreads over all tasks. Blocks are
bounded; nothing is gathered by language.

Nulls: null columns are hashed as ``-``; a null language is a group of its own,
the first; a null doc_id is the first of its language, and is never chosen for
tampering. Rows that repeat a doc_id are ordered by their leaf, so equal rows
are interchangeable. A lone leaf is its language's subroot, and a lone language's
subroot is the root. A proof without siblings is the hash of nothing. An empty
table gives an empty result; other columns are ignored, texts hashed whole.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import bucket_offsets, stored, temporaries

#: Levels of a block: it holds 2**HEIGHT nodes.
HEIGHT = 10
#: The columns of a leaf, in this order.
LEAF = ("doc_id", "source", "lang", "n_chars", "text")
#: Every row whose doc_id's checksum this divides is tampered with for the audit.
AUDIT = 7


def hashed(*nodes: bytes) -> bytes:
    """The parent of one or more nodes; nodes are lowercase hex."""
    return hashlib.sha256(b"".join(nodes)).hexdigest().encode()


class OpenTree:
    """Appends of nodes; each node's witness is a list of (level, sibling, whether the sibling is on the left).

    Subtrees that are complete but wait for their sibling are open, the highest
    first. Appending costs one hash for each subtree that closes.
    """

    def __init__(self) -> None:
        self.witnesses: list[list[tuple[int, bytes, bool]]] = []
        #: (height, root, first node, end) of the open subtrees.
        self.open: list[tuple[int, bytes, int, int]] = []

    def _opened(self, height: int, node: bytes, start: int, end: int) -> None:
        """Open a subtree, and close it with the one before for as long as they are equally high."""
        while self.open and self.open[-1][0] == height:
            _, left, first, _ = self.open.pop()
            for witness in self.witnesses[first:start]:
                witness.append((height, node, False))
            for witness in self.witnesses[start:end]:
                witness.append((height, left, True))
            height, node, start = height + 1, hashed(left, node), first
        self.open.append((height, node, start, end))

    def append(self, node: bytes) -> None:
        at = len(self.witnesses)
        self.witnesses.append([])
        self._opened(0, node, at, at + 1)

    def finish(self, levels: int) -> bytes:
        """Close what is open up to ``levels``; returns the node there."""
        while len(self.open) > 1 or self.open[0][0] < levels:
            height, node, start, end = self.open.pop()
            # Alone in its run: no sibling until it is as high as the subtree before it.
            self._opened(height + 1, hashed(node), start, end)
        return self.open[0][1]


def append_all(nodes: list[bytes], levels: int) -> tuple[bytes, list[list[tuple[int, bytes, bool]]]]:
    """The node ``levels`` above all of ``nodes``, and the witness of each."""
    tree = OpenTree()
    for node in nodes:
        tree.append(node)
    return tree.finish(levels), tree.witnesses


def packed(witness: list[tuple[int, bytes, bool]]) -> bytes:
    """A witness as bytes: for every sibling its level, its side and its digest (34 bytes)."""
    return b"".join(bytes((level, left)) + bytes.fromhex(sibling.decode()) for level, sibling, left in witness)


def unpacked(witness: bytes) -> list[tuple[int, bytes, bool]]:
    return [(witness[i], witness[i + 2:i + 34].hex().encode(), bool(witness[i + 1])) for i in range(0, len(witness), 34)]


def folded(node: bytes, witness: list[tuple[int, bytes, bool]], levels: int) -> bytes:
    """The node ``levels`` above ``node``, from its witness; a level without a sibling is hashed alone."""
    side = {level: (sibling, left) for level, sibling, left in witness}
    for level in range(levels):
        sibling, left = side.get(level, (b"", False))
        node = hashed(sibling, node) if left else hashed(node, sibling)
    return node


def _field(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_hash(**changed: Column) -> Column:
    """The leaf of a row, with columns changed."""
    return F.sha2(F.concat(*[_field(changed.get(c, F.col(c))) for c in LEAF]), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(lang, doc_id, leaf, changed): each row's leaf, and what it would be if its n_chars were one more, where audited."""
    audited = F.crc32(F.col("doc_id").cast("string")) % AUDIT == 0
    return docs.select("lang", "doc_id", leaf_hash().alias("leaf"),
                       F.when(audited, leaf_hash(n_chars=F.try_add(F.col("n_chars"), F.lit(1)))).alias("changed"))


def placed(rows: DataFrame) -> DataFrame:
    """(lang, doc_id, leaf, changed, place, size): each leaf's place in its language, from 0, and the language's size."""
    order = ["lang", "doc_id", "leaf"]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # The part of the sort is fixed by writing it; the number within is the row's place in its part.
    number = F.monotonically_increasing_id()
    sorted_rows = stored(sorted_rows.select("*", F.shiftright(number, 33).alias("part"), number.bitwiseAND((1 << 33) - 1).alias("number")), "leaves")
    group = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-"))
    counts = sorted_rows.groupBy(group.alias("group"), "part").agg(F.count("*").alias("n"), F.min("number").alias("least"))
    before = bucket_offsets(counts, ["group"], "part", "n", "before") \
        .withColumn("size", F.sum("n").over(Window.partitionBy("group"))).select("group", "part", "least", "before", "size")
    return sorted_rows.withColumn("group", group).join(before, ["group", "part"]) \
        .select("lang", "group", "doc_id", "leaf", "changed", (F.col("number") - F.col("least") + F.col("before")).alias("place"), "size")


def levels_of(size: Column) -> Column:
    """Levels above ``size`` nodes until one is left: the binary digits of size - 1."""
    return F.when(size <= 1, 0).otherwise(F.length(F.bin(size - 1)))


def _appended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Witnesses of the nodes of each block and the block's root, from rows (group, block, place, levels, node, row)."""
    held: tuple | None = None
    parts: list[pa.RecordBatch] = []

    def closed() -> pa.RecordBatch:
        group, block, levels = held
        rows = pa.Table.from_batches(parts).combine_chunks()
        nodes = rows["node"].to_pylist()
        root, witnesses = append_all([node.encode() for node in nodes], levels)
        n = len(nodes)
        return pa.RecordBatch.from_arrays(
            [pa.array([group] * n), pa.array([block] * n, pa.int64()), *[rows[c].combine_chunks() for c in ("place", "node", "row")],
             pa.array([packed(w) for w in witnesses], pa.binary()), pa.array([None] * (n - 1) + [root.decode()], pa.string())],
            ["group", "block", "place", "node", "row", "witness", "root"])
    for batch in batches:
        keys = list(zip(*[batch.column(i).to_pylist() for i in (0, 1, 3)]))
        starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
        for start, stop in zip(starts, [*starts[1:], len(keys)]):
            if held is not None and held != keys[start]:
                yield closed()
                parts = []
            held = keys[start]
            parts.append(batch.slice(start, stop - start))
    if parts:
        yield closed()


def _tier(nodes: DataFrame, name: str) -> DataFrame:
    """(group, block, place, node, row, witness, root) of one tier's nodes (group, place, levels, node, row).

    ``levels`` are those above the tier's nodes until the group has one node. A
    block's last row has its root.
    """
    blocks = nodes.select("group", F.shiftright("place", HEIGHT).alias("block"), "place",
                          F.least("levels", F.lit(HEIGHT)).alias("levels"), "node", "row")
    blocks = blocks.repartition("group", "block").sortWithinPartitions("group", "block", "place")
    kind = dict(nodes.dtypes)["row"]
    return stored(blocks.mapInArrow(_appended, f"group string, block long, place long, node string, row {kind}, "
                                               "witness binary, root string"), name)


def _grown(nodes: DataFrame, levels: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The tiers above ``nodes`` (group, place, levels, node, row) and each group's last node (group, node).

    ``levels`` is the largest number of levels of a group.
    """
    tiers: list[DataFrame] = []
    above = nodes.select("group", "levels").distinct()
    while True:
        tier = _tier(nodes, f"{name}-{len(tiers)}")
        tiers.append(tier)
        levels -= HEIGHT
        above = above.select("group", F.greatest(F.col("levels") - HEIGHT, F.lit(0)).alias("levels"))
        roots = tier.where("root is not null").select("group", F.col("block").alias("place"), F.col("root").alias("node"))
        if levels <= 0:
            return tiers, roots.select("group", "node")
        nodes = roots.join(above, "group").withColumn("row", F.lit(None).cast("string"))


def _paths(tiers: list[DataFrame]) -> DataFrame:
    """(group, block, path): the witnesses above each block of the lowest tier, as a list by tier."""
    top = tiers[-1].select("group", "block").distinct().withColumn("path", F.array().cast("array<binary>"))
    for tier in reversed(tiers[1:]):
        top = tier.join(top, ["group", "block"]).select("group", F.col("place").alias("block"),
                                                       F.concat(F.array("witness"), F.col("path")).alias("path"))
    return top


def _proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The siblings of each leaf up to the root, and the roots folded from the leaf and its change."""
    for batch in batches:
        siblings, roots = [], []
        for leaf, changed, levels, top, own, path, top_levels in zip(*[batch.column(i).to_pylist() for i in range(7)]):
            parts = [own, *path]
            witness = [(level + HEIGHT * tier, sibling, left) for tier, part in enumerate(parts) for level, sibling, left in unpacked(part)]
            witness += [(level + HEIGHT * tier + levels, sibling, left) for tier, part in enumerate(top) for level, sibling, left in unpacked(part)]
            siblings.append([sibling.decode() for _, sibling, _ in witness])
            roots.append(folded((changed or leaf).encode(), witness, levels + top_levels).decode())
        yield pa.RecordBatch.from_arrays([batch.column(7), batch.column(0), batch.column(8), pa.array(siblings, pa.list_(pa.string())),
                                          pa.array(roots, pa.string())], ["doc_id", "leaf", "subroot", "siblings", "folded_root"])


def manifest(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (with the columns LEAF): doc_id, leaf, subroot, root, siblings, folded_root, verified.

    ``siblings`` are the witness of the leaf up to the root; ``folded_root`` is
    recomputed from them and the leaf, which was tampered with where the audit
    chose its row, and ``verified`` says whether it is the root.
    """
    spark = docs.sparkSession
    with temporaries(spark) as keep:
        rows = placed(leaves(docs)).withColumn("levels", levels_of(F.col("size")))
        rows = stored(rows.select("group", "place", "levels", F.col("leaf").alias("node"), F.struct("doc_id", "changed", "levels").alias("row")), "placed")
        longest = rows.agg(F.max("levels")).first()[0] or 0
        tiers, subroots = _grown(rows, longest, "tier")
        subroots = stored(subroots, "subroots")
        # The tree of languages: byte order, the null one ("-") before all others ("=...").
        heads = placed(subroots.select(F.lit(None).cast("string").alias("lang"), F.col("group").alias("doc_id"),
                                       F.col("node").alias("leaf"), F.lit(None).cast("string").alias("changed")))
        heads = heads.select("group", "place", levels_of(F.col("size")).alias("levels"), F.col("leaf").alias("node"),
                             F.struct(F.col("doc_id").alias("lang")).alias("row"))
        heads = stored(heads, "languages")
        n_levels = heads.agg(F.max("levels")).first()[0] or 0
        top_tiers, root = _grown(heads, n_levels, "top")
        root = (root.first() or [None, None])[1]
        at_top = top_tiers[0].join(_paths(top_tiers), ["group", "block"]).select(
            F.col("row.lang").alias("group"), F.col("node").alias("subroot"), F.concat(F.array("witness"), F.col("path")).alias("top"))
        blocks = _paths(tiers).join(at_top, "group")
        own = tiers[0].join(blocks, ["group", "block"]).select(
            F.col("node").alias("leaf"), "row.changed", "row.levels", "top", "witness", "path", F.lit(n_levels).alias("top_levels"),
            "row.doc_id", "subroot")
        kind = dict(own.dtypes)["doc_id"]
        proofs = own.mapInArrow(_proofs, f"doc_id {kind}, leaf string, subroot string, siblings array<string>, folded_root string")
        done = keep(proofs, "proofs")
    return done.select("doc_id", "leaf", "subroot", F.lit(root).cast("string").alias("root"), "siblings", "folded_root",
                       (F.col("folded_root") == F.lit(root)).alias("verified"))
