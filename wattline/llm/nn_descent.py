"""Operator 5: embedding near-duplicates by NN-descent.

Equal vectors are one node. Every node's list of ``NEIGHBOURS`` starts from its
neighbours in several random sign-projection orders and is refined by joining
neighbours of neighbours (Dong et al., 2011): an edge v -> u meets the list of
u, and closer nodes replace farther ones in the lists of both ends, until few
entries change. Only pairs with a fresh edge are tried again.

Threshold edges form components: every pair at the threshold that an order or
a join meets between different components, whether or not a list has room for
it. A list that is saturated (all its entries reach the threshold) can't hold
all links of its node, so rounds repeat with new orders: from the second on, a
node has a list of the closest nodes of its own component and another of the
closest ones outside, and an order compares a row with the last rows of other
components before it. A link that leaves a component is thus never displaced by
links inside. Links inside a component are then counted exactly, block by block.

A pair at the threshold agrees in one sign with a fixed probability, so orders
of more rows part it more often: at least as many orders are made as leave such
a pair apart in all of them with a probability of 1 - ``RECALL``, then rounds
repeat until one adds no edge. Recall is audited against brute force over two
bounded seeded samples, of all nodes and of those whose lists aren't saturated,
as the smaller of the shares over links and over nodes. More orders are made
while it is below ``RECALL``; if ``EXTRA_ORDERS`` times the orders don't reach
it, the query fails and names it. Found misses are kept as edges.

Nothing here grows with the degree of a node: lists are bounded, hubs are
split by adaptive joins, a component is handled in pairs of bounded blocks
whose rows are counted, never emitted as pairs.

Nulls: vectors that are null, empty, zero, of another than the most common
dimension, or that hold null or non-finite components link with nothing; each
is its own component. A null vec_id never names a component unless nothing
else does. Rows that repeat a vec_id are separate vectors. An empty table
gives an empty result.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import ARROW_ROWS, stored, unit_hash
from wattline.llm.components import connected_components

THRESHOLD = 0.95
NEIGHBOURS = 8
#: Orders of one round.
ORDERS = 12
#: Following nodes of an order that a node is compared with.
STEPS = 3
BITS = 62
ITERATIONS = 5
#: Refinement ends when less than this share of all list entries changed.
CHANGE = 0.01
AUDITED = 500
RECALL = 0.995
#: Orders after which a recall below RECALL is an error, as a multiple of ``orders_needed``.
EXTRA_ORDERS = 4
#: Members of a component that are compared with each other at once.
BLOCK = 512


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision, first by their largest component."""
    v = vectors.astype(np.float64)
    v = v / np.maximum(np.abs(v).max(1, keepdims=True), 1e-300)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as a matrix of unit vectors."""
    at = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)[at[0]:at[-1]]
    return unit(flat.reshape(-1, dim)) if len(flat) else np.zeros((0, dim))


def _pairs_batch(a, b, sim, own=None) -> pa.RecordBatch:
    columns = [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sim, pa.float64())]
    names = ["v", "id", "sim"]
    return pa.RecordBatch.from_arrays(columns, names) if own is None else \
        pa.RecordBatch.from_arrays(columns + [pa.array(own, pa.bool_())], names + ["own"])


def _project(dim: int, orders: range):
    """(trial, place, node, vec, component): each node's place in every order, from the signs of seeded projections."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = [np.random.default_rng([5, t]).standard_normal((dim, BITS)) for t in orders]
        bits = (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
        for batch in batches:
            v = _matrix(batch.column(1), dim)
            for t, plane in zip(orders, planes):
                place = ((v @ plane) > 0).astype(np.int64) @ bits
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(v), t, np.int32)), pa.array(place), batch.column(0), batch.column(1), batch.column(2)],
                    ["trial", "place", "node", "vec", "component"])
    return run


def _window(dim: int):
    """Similarities of each row and the last rows of the STEPS runs before its own in the sorted partition.

    A run is a row and those that follow it in the same component.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trial, node, component, vec = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, dim))
        for batch in batches:
            held = len(node)
            trial = np.concatenate([trial, batch.column(0).to_numpy()])
            node = np.concatenate([node, batch.column(2).to_numpy()])
            vec = np.concatenate([vec, _matrix(batch.column(3), dim)])
            component = np.concatenate([component, batch.column(4).to_numpy()])
            ends = (np.diff(component) != 0) | (np.diff(trial) != 0)
            place = np.concatenate([[0], np.cumsum(ends)]).astype(np.int64)[:len(node)]
            last = np.append(np.flatnonzero(ends), len(node) - 1)
            for step in range(1, STEPS + 1):
                hi = np.arange(held, len(node))
                hi = hi[place[hi] >= step]
                lo = last[place[hi] - step]
                near = (trial[hi] == trial[lo]) & (component[hi] != component[lo])
                hi, lo = hi[near], lo[near]
                sim, own = (vec[hi] * vec[lo]).sum(1), np.zeros(len(hi), bool)
                yield _pairs_batch(node[hi], node[lo], sim, own)
                yield _pairs_batch(node[lo], node[hi], sim, own)
            kept = last[-STEPS - 1:] if len(node) else last[:0]
            trial, node, component, vec = trial[kept], node[kept], component[kept], vec[kept]
    return run


def _meet(dim: int, threshold: float):
    """Each edge v -> u with the lists of u: candidates closer to v than its farthest neighbour of their kind.

    Pairs of different components at the threshold are links and always candidates.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, vec = batch.column(0).to_numpy(), _matrix(batch.column(1), dim)
            component, fresh = batch.column(2).to_numpy(), batch.column(5).to_numpy(zero_copy_only=False)
            least = np.stack([batch.column(3).to_numpy(), batch.column(4).to_numpy()])
            lists = batch.column(6)
            at, inner = lists.offsets.to_numpy(), lists.values
            w = inner.field(0).to_numpy()[at[0]:at[-1]]
            w_fresh = inner.field(1).to_numpy(zero_copy_only=False)[at[0]:at[-1]]
            w_vec = _matrix(inner.field(2).slice(at[0], at[-1] - at[0]), dim)
            w_component = inner.field(3).to_numpy()[at[0]:at[-1]]
            row = np.repeat(np.arange(len(v)), np.diff(at))
            new = (fresh[row] | w_fresh) & (w != v[row])
            row, w, w_vec, own = row[new], w[new], w_vec[new], (w_component == component[row])[new]
            sim = (vec[row] * w_vec).sum(1)
            keep = (sim > least[own.astype(np.int64), row]) | (~own & (sim >= threshold))
            yield _pairs_batch(v[row[keep]], w[keep], sim[keep], own[keep])
            yield _pairs_batch(w[keep], v[row[keep]], sim[keep], own[keep])
    return run


PAIR = "v long, id long, sim double"
LISTED = f"{PAIR}, own boolean"


def _closest(pairs: DataFrame) -> DataFrame:
    """The NEIGHBOURS closest entries of each node inside and outside its component; a partial limit runs before the shuffle."""
    rank = F.row_number().over(Window.partitionBy("v", "own").orderBy(F.col("sim").desc(), "id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= NEIGHBOURS).drop("rank")


def _merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """(v, id, sim, own, fresh): the entries of both, fresh where only ``new`` has them."""
    found = old.select("v", "id", "sim", "own", F.lit(False).alias("fresh")).unionByName(new.withColumn("fresh", F.lit(True)))
    return found.groupBy("v", "id").agg(F.max("sim").alias("sim"), F.max("own").alias("own"), F.min("fresh").alias("fresh"))


def start_lists(vecs: DataFrame, dim: int, orders: range) -> DataFrame:
    """(v, id, sim, own): pairs of components next to each other in random sign-projection orders."""
    kind = dict(vecs.dtypes)["vec"]
    placed = vecs.mapInArrow(_project(dim, orders), f"trial int, place long, node long, vec {kind}, component long")
    placed = placed.repartitionByRange("trial", "place").sortWithinPartitions("trial", "place", "node")
    return placed.mapInArrow(_window(dim), LISTED)


def descend(lists: DataFrame, met: DataFrame, vecs: DataFrame, dim: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Lists (v, id, sim, own) refined from ``met`` pairs until few entries change, and the links found (v, id).

    Links are pairs of different components at the threshold, in a list or not.
    """
    links, n = None, None
    for _ in range(ITERATIONS + 1):
        both = stored(_merged(lists, met), "met")
        found = both.where(~F.col("own") & (F.col("sim") >= threshold)).select("v", "id")
        links = found if links is None else links.unionByName(found)
        lists = stored(_closest(both), "lists")
        counts = lists.agg(F.count("*"), F.count_if("fresh")).first()
        if n is not None and counts[1] <= CHANGE * max(1, n):
            break
        n = counts[0] if n is None else n
        listed = lists.join(vecs.select(F.col("node").alias("id"), "vec", "component"), "id") \
            .groupBy(F.col("v").alias("u")).agg(F.collect_list(F.struct("id", "fresh", "vec", "component")).alias("list"))

        def least(own: bool):
            of = F.when(F.col("own") == own, F.col("sim"))
            return F.when(F.count(of) >= NEIGHBOURS, F.min(of)).otherwise(F.lit(-2.0))
        farthest = lists.groupBy("v").agg(least(False).alias("least_out"), least(True).alias("least_own"))
        edges = lists.select("v", F.col("id").alias("u"), "fresh").join(
            vecs.select(F.col("node").alias("v"), "vec", "component").join(farthest, "v"), "v")
        tried = edges.join(listed, "u").where(F.col("fresh") | F.exists("list", lambda e: e["fresh"]))
        met = tried.select("v", "vec", "component", "least_out", "least_own", "fresh", "list") \
            .mapInArrow(_meet(dim, threshold), LISTED)
    return lists, links


def _relabelled(vecs: DataFrame, links: DataFrame) -> tuple[DataFrame, bool]:
    """``vecs`` with the components that ``links`` (v, id) join named as one, and whether there is any such."""
    at = vecs.select("node", "component")
    ends = links.distinct().join(at.select(F.col("node").alias("v"), F.col("component").alias("a")), "v") \
        .join(at.select(F.col("node").alias("id"), F.col("component").alias("b")), "id").where("a != b")
    ends = stored(ends.select("a", "b").distinct(), "joined")
    if ends.isEmpty():
        return vecs, False
    names = connected_components(ends).select(F.col("node").alias("component"), F.col("component").alias("name"))
    return stored(vecs.join(names, "component", "left").select(
        "node", "vec", F.coalesce("name", "component").alias("component")), "labelled"), True


def _own(lists: DataFrame, vecs: DataFrame) -> DataFrame:
    """``lists`` with ``own`` by the present components."""
    at = vecs.select("node", "component")
    return lists.select("v", "id", "sim").join(at.select(F.col("node").alias("v"), F.col("component").alias("a")), "v") \
        .join(at.select(F.col("node").alias("id"), F.col("component").alias("b")), "id") \
        .select("v", "id", "sim", (F.col("a") == F.col("b")).alias("own"))


def orders_needed(n: int, threshold: float) -> int:
    """Orders that part a pair at the threshold among n nodes in all of them with a probability of 1 - RECALL at most."""
    agree = 1 - math.acos(min(1.0, max(-1.0, threshold))) / math.pi
    together = agree ** math.log2(max(2, n))
    return math.ceil(math.log(1 - RECALL) / math.log1p(-together)) if 0 < together < 1 else 1


def _sampled(vecs: DataFrame, seed: int):
    """A bounded seeded sample of nodes (node, vec), on the driver."""
    total = max(1, vecs.count())
    return vecs.where(unit_hash(seed, "node") < AUDITED / total).select("node", "vec").limit(2 * AUDITED).toPandas()


def _audit(vecs: DataFrame, lists: DataFrame, dim: int, threshold: float) -> DataFrame:
    """(v, id, sim): all links of bounded seeded samples of nodes, by brute force against every node.

    One sample is of all nodes, the other of those that have fewer than NEIGHBOURS links in ``lists``.
    """
    full = lists.where(F.col("sim") >= threshold).groupBy("v").count().where(F.col("count") >= NEIGHBOURS)
    loose = stored(vecs.join(full.select(F.col("v").alias("node")), "node", "left_anti"), "loose")
    sample = pd.concat([_sampled(vecs, 55), _sampled(loose, 56)]).drop_duplicates("node")
    if not len(sample):
        return vecs.sparkSession.createDataFrame([], PAIR)
    ids, queries = sample["node"].to_numpy(np.int64), unit(np.array(sample["vec"].tolist(), dtype=np.float64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, matrix = batch.column(0).to_numpy(), _matrix(batch.column(1), dim)
            for lo in range(0, len(ids), BLOCK):
                of = ids[lo:lo + BLOCK]
                sim = matrix @ queries[lo:lo + BLOCK].T
                r, q = np.nonzero(sim >= threshold)
                other = node[r] != of[q]
                yield _pairs_batch(of[q][other], node[r][other], sim[r, q][other])
    return stored(vecs.select("node", "vec").mapInArrow(run, PAIR), "audit")


def _recall(audit: DataFrame, nodes: DataFrame) -> float:
    """The smaller of two shares of audited links that lie in one component: of all, and the mean of each node's share."""
    each = _own(audit, nodes).groupBy("v").agg(F.count("*").alias("n"), F.count_if("own").alias("found"))
    pairs, per_node = each.agg(F.sum("found") / F.sum("n"), F.avg(F.col("found") / F.col("n"))).first()
    return 1.0 if pairs is None else min(pairs, per_node)


def _block_links(dim: int, threshold: float):
    """(node, links): for each row of one block, its links into another block, weighted by copies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine, others = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                a, b = mine[i].values, others[i].values
                sim = _matrix(a.field(1), dim) @ _matrix(b.field(1), dim).T
                node, other = a.field(0).to_numpy(), b.field(0).to_numpy()
                links = ((sim >= threshold) & (node[:, None] != other[None, :])) @ b.field(2).to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(links.astype(np.int64))], ["node", "links"])
    return run


def _count_links(members: DataFrame, dim: int, threshold: float) -> DataFrame:
    """(node, links) inside components (node, component, copies, vec): all pairs of blocks of BLOCK nodes.

    A component's nodes are dealt to blocks by hash; each pair of blocks is a
    row of its own, so a large component spreads over tasks.
    """
    sizes = stored(members.groupBy("component").agg(F.count("*").alias("size")).where("size > 1"), "component-sizes")
    n_blocks = F.ceil(F.col("size") / F.lit(BLOCK))
    dealt = members.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("node"), n_blocks))
    blocks = stored(dealt.groupBy("component", "block").agg(
        F.collect_list(F.struct("node", "vec", "copies")).alias("rows")), "blocks")
    pairs = blocks.join(blocks.select("component", F.col("rows").alias("others")), "component")
    counted = stored(pairs.select("rows", "others").mapInArrow(_block_links(dim, threshold), "node long, links long"),
                     "block-links", rows=(ARROW_ROWS, 16))
    return counted.groupBy("node").agg(F.sum("links").alias("links"))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, key: str = "vec_id",
                    embedding: str = "embedding") -> tuple[DataFrame, float]:
    """One row per vector (vec_id, n_links, component_id, kept), and the audited recall of links."""
    x = F.col(embedding)
    size = F.size(x)
    dims = vectors.where(x.isNotNull() & (size > 0)).groupBy(size.alias("d")).count().orderBy(F.desc("count"), "d").first()
    dim = dims["d"] if dims else 1
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    valid = F.coalesce((size == dim) & finite & F.exists(x, lambda c: c != 0), F.lit(False))
    rows = stored(vectors.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("vec_id"),
                                 F.when(valid, x).alias("vec")), "vectors")
    vecs = stored(rows.where("vec is not null").groupBy("vec").agg(F.min("row").alias("node"), F.count("*").alias("copies"))
                  .select("node", "vec", "copies"), "nodes")
    nodes = vecs.select("node", "vec", F.col("node").alias("component"))
    lists, audit, recall, done = vectors.sparkSession.createDataFrame([], LISTED), None, 1.0, 0
    needed = orders_needed(nodes.count(), threshold)
    while True:
        lists, links = descend(_own(lists, nodes), start_lists(nodes, dim, range(done, done + ORDERS)), nodes, dim, threshold)
        nodes, joined = _relabelled(nodes, links)
        done += ORDERS
        if joined or done < needed:
            continue
        audit = audit or _audit(nodes, lists, dim, threshold)
        recall = _recall(audit, nodes)
        if recall >= RECALL:
            break
        if done >= EXTRA_ORDERS * needed:
            raise RuntimeError(f"near-duplicates: recall of audited links is {recall:.4f} after {done} orders, below {RECALL}")
    nodes, _ = _relabelled(nodes, audit.select("v", "id"))
    labels = nodes.select("node", "component")
    members = vecs.join(labels, "node").select("node", "component", "copies", "vec")
    links = _count_links(members, dim, threshold)
    owner = rows.where("vec is not null").join(vecs.select("vec", "node", "copies"), "vec").select("row", "vec_id", "node", "copies")
    known = stored(owner.join(labels, "node", "left").join(links, "node", "left").select(
        "row", "vec_id", F.coalesce("component", "node").alias("component"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "members")
    names = known.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    alone = rows.where("vec is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = known.join(names, "component").select("vec_id", "n_links", "component_id").unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))), recall
