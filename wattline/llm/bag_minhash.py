"""Operator 10: near-duplicate documents by BagMinHash.

A document is the multiset of its shingles of five words (lower case, cut at
ASCII white space). BagMinHash (Ertl, 2018) signs weighted sets: every shingle
carries Poisson processes over intervals of its weight, here whole numbers, so
the levels are exact. A process over a wide interval is split into its halves
only when its next point is below the document's current maximum, so most of a
heavy weight is never visited. Two documents agree in a slot with a
probability equal to their weighted Jaccard similarity.

Signatures are cut into bands; documents that share a band are candidates, and
a candidate pair is a link if the overlap of the whole multisets is at least
``THRESHOLD``. Classes are the connected components of the links.

No group becomes rows of all its pairs: equal texts are one node, and a band's
bucket first links its members to its smallest node. Where a bucket still holds
several components, ``ROUNDS`` rounds compare its members with ``CENTRES`` of
its nodes in other components. Members that are still apart meet in pairs of
blocks of bounded size, where a matrix product gives all exact overlaps at once
and only links that join two components come out.

Nulls: a null text is empty. Texts of one to four words are one shingle; empty
texts are equal to each other and to nothing else. A null doc_id is kept last
and named by the smallest id of its class. An empty table gives an empty
result.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.llm.common import (
    ARROW_ROWS, HASH_GROUPS, gathered, release_shuffles, row_mark, small_batches, stored, temporaries, text_or_empty,
)
from wattline.llm.components import connected_components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 25, 5
SLOTS = BANDS * ROWS
#: Nodes of a bucket that its members are compared with in each round, and rounds (each draws others).
CENTRES, ROUNDS = 16, 2
#: Buckets (its largest) in which a node takes part in a round; the blocks that follow cover all.
ROUND_BUCKETS = 1
#: Shingles of a bucket's members that one block holds, about (a longer document is a block of its own).
BLOCK_SHINGLES = 16_000
#: Blocks that a tile takes from each side, and tiles that are gathered in a hash map at once.
TILE, TILES_AT_ONCE = 8, 64
#: Words of documents that are signed together within a worker.
SLICE_WORDS = 400_000

U = np.uint64


# --- hashing ------------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingle_hashes(words: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of documents, and how many each has.

    ``words``: 64-bit word hashes, document by document; ``n``: words of each.
    """
    with np.errstate(over="ignore"):
        words = _mix(words.astype(U))
        count = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
        starts = np.repeat(np.cumsum(n) - n, count)
        first = np.repeat(np.cumsum(count) - count, count)
        at = starts + np.arange(len(starts)) - first
        length = np.repeat(np.minimum(n, SHINGLE), count)
        out = length.astype(U)
        for k in range(SHINGLE):
            inside = length > k
            word = words[np.where(inside, at + k, 0)] if len(words) else words
            out = np.where(inside, out * U(0x9E3779B97F4A7C15) + word, out)
        return _mix(out), count


def weigh(shingles: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, weight) of the different shingles of each document."""
    doc = np.repeat(np.arange(len(count)), count)
    order = np.lexsort((shingles, doc))
    doc, shingles = doc[order], shingles[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (shingles[1:] != shingles[:-1])
    at = np.flatnonzero(new)
    return doc[at], shingles[at], np.diff(np.concatenate([at, [len(doc)]]))


def sign(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n_docs: int, slots: int = SLOTS) -> np.ndarray:
    """Signatures (n_docs x slots): the point that comes first in each slot.

    Frontier arrays hold one Poisson process each: its weight interval
    [low, low + width), its next point and the number of points drawn so far.
    """
    with np.errstate(over="ignore", divide="ignore"):
        best = np.full(n_docs * slots, np.inf)
        names = np.zeros(n_docs * slots, dtype=U)
        limit = np.full(n_docs, np.inf)
        d, s, w = doc.astype(np.int64), shingle.astype(U), weight.astype(np.int64)
        # Roots [0,1), [1,2), [2,4), [4,8), ... below each weight.
        parts, low = [], 0
        while True:
            above = np.flatnonzero(w > low)
            if not above.size:
                break
            width = max(1, low)
            parts.append((d[above], s[above], w[above], np.full(above.size, low), np.full(above.size, width)))
            low += width
        if not parts:
            return names.reshape(n_docs, slots)
        d, s, w, low, width = (np.concatenate(x) for x in zip(*parts))

        def drawn(s, low, width, k):
            seed = _mix(s + low.astype(U) * U(0xD6E8FEB86659FD93) + width.astype(U) * U(0xA0761D6478BD642F))
            return _mix(seed + (k + 1).astype(U) * U(0x9E3779B97F4A7C15))

        def gap(bits, width):
            return -np.log(((bits >> U(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / width

        k = np.zeros(len(d), dtype=np.int64)
        x = gap(drawn(s, low, width, k), width)
        while d.size:
            near = x < limit[d]
            d, s, w, low, width, k, x = (v[near] for v in (d, s, w, low, width, k, x))
            if not d.size:
                break
            unit = width == 1
            # Unit processes put their point into a slot and draw the next one.
            u = np.flatnonzero(unit)
            name = drawn(s[u], low[u], width[u], k[u])
            slot = (_mix(name) >> U(32)) * U(slots) >> U(32)
            cell = d[u] * slots + slot.astype(np.int64)
            np.minimum.at(best, cell, x[u])
            won = best[cell] == x[u]
            names[cell[won]] = name[won]
            touched = np.unique(d[u])
            limit[touched] = best.reshape(n_docs, slots)[touched].max(1)
            k[u] += 1
            x[u] += gap(drawn(s[u], low[u], width[u], k[u]), 1)
            # Wider processes are split: the point falls into one half, the other draws its own after it.
            v = np.flatnonzero(~unit)
            if v.size:
                half = width[v] // 2
                right = (drawn(s[v], low[v], width[v], k[v] + (1 << 20)) & U(1)).astype(np.int64)
                has, other = low[v] + right * half, low[v] + (1 - right) * half
                none = np.zeros(v.size, np.int64)
                other_x = x[v] + gap(drawn(s[v], other, half, none), half)
                # A half that starts with its parent's point draws on from its own second number.
                d = np.concatenate([d[u], d[v], d[v]])
                s = np.concatenate([s[u], s[v], s[v]])
                w = np.concatenate([w[u], w[v], w[v]])
                x = np.concatenate([x[u], x[v], other_x])
                k = np.concatenate([k[u], none, none])
                low, width = np.concatenate([low[u], has, other]), np.concatenate([width[u], half, half])
                inside = low < w
                d, s, w, low, width, k, x = (y[inside] for y in (d, s, w, low, width, k, x))
        return names.reshape(n_docs, slots)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """(documents x BANDS) hashes of the bands."""
    with np.errstate(over="ignore"):
        cut = signatures.reshape(len(signatures), BANDS, ROWS)
        key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U), cut.shape[:2]).copy()
        for r in range(ROWS):
            key = _mix(key * U(0x9E3779B97F4A7C15) + cut[:, :, r])
        return key


def elements(shingles: np.ndarray, count: np.ndarray) -> list[np.ndarray]:
    """Each document's multiset as a set: the hash of (shingle, number of its occurrence)."""
    doc, shingle, weight = weigh(shingles, count)
    with np.errstate(over="ignore"):
        at = np.repeat(np.arange(len(doc)), weight)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(weight) - weight, weight)
        out = _mix(shingle[at] + nth.astype(U) * U(0xD1342543DE82EF95))
    return np.split(out.view(np.int64), np.cumsum(count)[:-1]) if len(count) else []


# --- Spark --------------------------------------------------------------------

def _words(text: str) -> Column:
    return F.regexp_extract_all(F.lower(text_or_empty(text)), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))


def bags(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, mark, bag, words): the bag names the sequence of words, so copies share it."""
    rows = docs.select(F.col(key).alias("doc_id"), row_mark(key, text).alias("mark"), _words(text).alias("words"))
    return rows.select("doc_id", "mark", F.unhex(F.md5(F.array_join("words", " "))).alias("bag"),
                       F.transform("words", lambda w: F.xxhash64(w)).alias("words"))


def _pieces(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with about SLICE_WORDS words: first row, rows, word hashes, words of each."""
    lists = batch.column(column)
    at, values = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy(zero_copy_only=False).view(U)
    lo = 0
    while lo < len(lists):
        hi = int(max(lo + 1, np.searchsorted(at, at[lo] + SLICE_WORDS, side="right") - 1))
        yield lo, hi - lo, values[at[lo]:at[hi]], np.diff(at[lo:hi + 1])
        lo = hi


def _lists(rows: list[np.ndarray] | np.ndarray) -> pa.ListArray:
    sizes = np.array([len(r) for r in rows], dtype=np.int64)
    flat = np.concatenate(rows) if len(rows) else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)),
                                    pa.array(flat.view(np.int64)))


def _sign_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, n_rows, words, n in _pieces(batch, 4):
            shingles, count = shingle_hashes(words, n)
            keys = band_keys(sign(*weigh(shingles, count), n_rows))
            keys = [k if c else k[:0] for k, c in zip(keys, count)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).slice(lo, n_rows) for i in range(4)] + [_lists(keys)],
                ["row", "doc_id", "mark", "bag", "bands"])


def _element_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, n_rows, words, n in _pieces(batch, 1):
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, n_rows),
                                              _lists(elements(*shingle_hashes(words, n)))], ["node", "elements"])


def sketch(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, mark, bag, bands) of every document; ``row`` numbers the rows of the stored table."""
    rows = bags(docs, key, text).select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"),
                                         "mark", "bag", "words")
    return stored(rows.mapInArrow(_sign_rows, "row long, doc_id long, mark binary, bag binary, bands array<long>"), "sketch")


def _shared(buckets: DataFrame) -> DataFrame:
    """(band, node, first) of the buckets that hold several nodes, ``first`` the smallest of them; no other bucket holds a pair."""
    n = buckets.count()
    first = buckets.groupBy("band").agg(F.min("node").alias("first"), F.max("node").alias("last"))
    first = stored(gathered(first.where("first != last").select("band", "first"), n), "buckets")
    return stored(gathered(buckets.join(first, "band").select("band", "node", "first"), n), "shared-buckets")


def _stars(shared: DataFrame) -> DataFrame:
    """Different pairs (a, b) of each bucket's smallest node and its other members."""
    star = shared.where("node != first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    return stored(gathered(star.distinct(), shared.count()), "stars")


def _renamed(df: DataFrame, names: DataFrame, column: str) -> DataFrame:
    """``df`` with the components in ``column`` named anew by ``names`` (node, component); others keep their names."""
    names = names.select(F.col("node").alias(column), F.col("component").alias("_name"))
    return df.join(names, column, "left").withColumn(column, F.coalesce("_name", column)).drop("_name")


def _split(named: DataFrame) -> DataFrame:
    """(band, node, component, size) of the members of buckets (band, node, component) that hold more than one component."""
    named = stored(named, "named-buckets")
    split = named.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                      F.count("*").alias("size")).where("low != high")
    split = stored(gathered(split.select("band", "size"), named.count()), "split-buckets")
    return stored(named.join(split, "band").select("band", "node", "component", "size"), "split")


def _centre_pairs(split: DataFrame, seed: int) -> DataFrame:
    """Different pairs (a, b) of members of split buckets and a few seeded nodes of other components in their buckets.

    ``low`` and ``high`` are the two components.

    The same nodes tend to be drawn in all buckets of a group, so pairs stay few.
    """
    drawn = F.row_number().over(Window.partitionBy("band").orderBy(F.xxhash64(F.lit(seed), "node"), "node"))
    centres = split.withColumn("rank", drawn).where(F.col("rank") <= CENTRES) \
        .select("band", F.col("node").alias("centre"), F.col("component").alias("other"))
    largest = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("size"), "band"))
    members = split.withColumn("rank", largest).where(F.col("rank") <= ROUND_BUCKETS)
    centres = stored(gathered(centres, split.count()), "centres")
    pairs = members.join(centres, "band").where("component != other") \
        .select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"),
                F.least("component", "other").alias("low"), F.greatest("component", "other").alias("high"))
    return stored(pairs.distinct(), "centre-pairs")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of one list shares with each of another, by a product of incidence matrices."""
    common = np.intersect1d(np.concatenate(left), np.concatenate(right))

    def incidence(sets: list[np.ndarray]) -> np.ndarray:
        flat, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        at = np.minimum(np.searchsorted(common, flat), max(0, len(common) - 1))
        held = common[at] == flat if len(common) else np.zeros(len(flat), bool)
        out = np.zeros((len(sets), len(common)), np.float32)
        out[row[held], at[held]] = 1.0
        return out
    return incidence(left) @ incidence(right).T


def _compare_tiles(threshold: float):
    """Links (a, b) of a tile, with their components: enough to join every two components that any compared pair joins."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, ...]] = []
            for i in range(batch.num_rows):
                lane, group, members = batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), batch.column(2)[i].values
                block, node, component = (members.field(k).to_numpy() for k in range(3))
                at, values = members.field(3).offsets.to_numpy(), members.field(3).values.to_numpy()
                blocks = {}
                for b in np.unique(block):
                    rows = np.flatnonzero(block == b)
                    blocks[int(b)] = rows, [values[at[r]:at[r + 1]] for r in rows], (at[rows + 1] - at[rows]).astype(np.float64)
                root: dict[int, int] = {}

                def top(c: int) -> int:
                    while root.get(c, c) != c:
                        c = root[c]
                    return c
                for p, (rows_p, sets_p, n_p) in blocks.items():
                    for q, (rows_q, sets_q, n_q) in blocks.items():
                        if p < 0 or p // TILE != group or q // TILE != lane or 0 <= q < p:
                            continue
                        apart = component[rows_p][:, None] != component[rows_q][None, :]
                        if not apart.any():
                            continue
                        both = _overlaps(sets_p, sets_q).astype(np.float64)
                        hits = apart & (both >= threshold * (n_p[:, None] + n_q[None, :] - both) - 1e-9)
                        for k, m in zip(*np.nonzero(hits)):
                            a, b = int(rows_p[k]), int(rows_q[m])
                            x, y = top(int(component[a])), top(int(component[b]))
                            if x != y:
                                root[max(x, y)] = min(x, y)
                                found.append((int(node[a]), int(node[b]), int(component[a]), int(component[b])))
            columns = zip(*found) if found else ((),) * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "low", "high"])
    return run


def _different(split: DataFrame) -> DataFrame:
    """The rows of one bucket of those that hold the same nodes: the others would repeat its comparisons.

    128 bits stand for the nodes of a bucket, as they do for a text.
    """
    nodes = [F.bit_xor(F.xxhash64(F.lit(seed), "node")).alias(f"nodes_{seed}") for seed in (1, 2)]
    named = split.groupBy("band").agg(F.count("*").alias("n"), *nodes)
    kept = named.groupBy("n", "nodes_1", "nodes_2").agg(F.min("band").alias("band")).select("band")
    return stored(split.join(stored(kept, "different-buckets"), "band", "left_semi"), "different")


def _block_links(split: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links that join components of the members of split buckets, whatever pair of members they need.

    A bucket's largest component has blocks of its own: these meet the blocks
    of the others, never each other, so a large group costs its size times its
    few members that are still apart. Blocks meet in tiles of up to ``TILE``
    from each side, gathered like any group: a join of the blocks by bucket
    would hold all of a large bucket on both sides.
    """
    split = _different(split)
    sized = split.join(sets.select("node", F.size("elements").alias("n")), "node")
    parts = sized.groupBy("band", "component").agg(F.sum("n").alias("n"))
    counts = parts.groupBy("band").agg(F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("n"))

    def n_blocks(n: Column) -> Column:
        return F.greatest(F.ceil(n / F.lit(BLOCK_SHINGLES)), F.lit(1))
    one = F.col("n") <= BLOCK_SHINGLES
    counts = counts.select("band", F.when(~one, F.col("main.component")).alias("main"), n_blocks(F.col("main.n")).alias("n_main"),
                           F.when(one, F.lit(1)).otherwise(n_blocks(F.col("n") - F.col("main.n"))).alias("n_rest"))
    counts = stored(counts, "block-counts")
    # Blocks and lanes of the largest component are numbered downwards from -1. A small bucket is one block.
    mixed = F.xxhash64("node")
    block = F.when(F.col("component") == F.col("main"), -1 - F.pmod(mixed, "n_main")).otherwise(F.pmod(mixed, "n_rest"))
    dealt = split.join(counts, "band").select("band", "main", "n_main", "n_rest", "node", "component", block.alias("block"))
    own, last = F.floor(F.col("block") / TILE), F.floor((F.col("n_rest") - 1) / TILE)
    first = F.when(F.col("main").isNull(), F.lit(0)).otherwise(F.floor(-F.col("n_main") / TILE))
    lanes = F.transform(F.sequence(F.lit(0).cast("long"), F.when(F.col("block") < 0, last).otherwise(own)),
                        lambda g: F.struct(own.alias("lane"), g.alias("group")))
    groups = F.transform(F.array_union(F.sequence(first.cast("long"), F.lit(0).cast("long")), F.sequence(F.lit(0).cast("long"), last)),
                         lambda k: F.struct(k.alias("lane"), own.alias("group")))
    groups = F.filter(groups, lambda t: (t["lane"] < 0) | (t["lane"] >= t["group"]))
    tiles = F.when(F.col("block") < 0, lanes).otherwise(F.array_union(lanes, groups))
    placed = dealt.select("band", "node", "component", "block", F.explode(tiles).alias("tile"))
    tiles = placed.join(sets, "node").groupBy("band", "tile").agg(
        F.collect_list(F.struct("block", "node", "component", "elements")).alias("members"))
    found = tiles.select("tile.lane", "tile.group", "members") \
        .mapInArrow(_compare_tiles(threshold), "a long, b long, low long, high long")
    return stored(found, "block-links", rows=(ARROW_ROWS, 8), groups=(HASH_GROUPS, TILES_AT_ONCE))


def _linked(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b and more columns) whose multisets overlap by the threshold or more."""
    left = sets.select(F.col("node").alias("a"), F.col("elements").alias("ea"))
    right = sets.select(F.col("node").alias("b"), F.col("elements").alias("eb"))
    both = F.size(F.array_intersect("ea", "eb"))
    least = F.least(F.size("ea"), F.size("eb")) / F.greatest(F.size("ea"), F.size("eb"))
    joined = pairs.join(right, "b").join(left, "a").where(least >= threshold)
    return joined.where(both >= threshold * (F.size("ea") + F.size("eb") - both) - 1e-9).select(*pairs.columns)


def _element_sets(docs: DataFrame, nodes: DataFrame, key: str, text: str) -> DataFrame:
    """(node, elements) of the given nodes (node, bag), from the whole texts."""
    words = bags(docs, key, text).select("bag", "words").join(nodes, "bag")
    one = words.groupBy("node").agg(F.first("words").alias("words"))
    return stored(one.mapInArrow(_element_rows, "node long, elements array<long>"), "element-sets")


def near_dedup(docs: DataFrame, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id, class_size, n_texts, kept, mark.

    ``class_id`` is the smallest doc_id of the class, ``n_texts`` the number of
    its different texts; the kept document is the one with that id.
    """
    small_batches(docs.sparkSession)
    with temporaries(docs.sparkSession) as keep:
        rows = sketch(docs, key, text)
        nodes = stored(rows.groupBy("bag").agg(F.min("row").alias("node")), "nodes")
        heads = rows.join(nodes.select(F.col("node").alias("row")), "row", "left_semi").withColumnRenamed("row", "node")
        buckets = stored(heads.select("node", F.explode("bands").alias("band")), "bands")
        buckets = _shared(buckets)
        pairs = _stars(buckets)
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        sets = _element_sets(docs, nodes.join(wanted, "node", "left_semi"), key, text)
        links = stored(_linked(pairs, sets, threshold), "links")
        labels = connected_components(links)
        release_shuffles(docs.sparkSession)
        component = F.coalesce("component", "node")
        named, renames = buckets.join(labels, "node", "left").select("band", "node", component.alias("component")), []
        for step in range(ROUNDS + 1):
            split = _split(named)
            if split.isEmpty():
                break
            more = stored(_linked(_centre_pairs(split, step), sets, threshold), "links") if step < ROUNDS \
                else _block_links(split, sets, threshold)
            # Components only grow, so a bucket of one component stays so; the shuffles of the round are not needed again.
            named = split.select("band", "node", "component")
            if not more.isEmpty():
                # The round's links join components: these few are named anew, not all nodes.
                renames.append(connected_components(more.select(F.col("low").alias("a"), F.col("high").alias("b"))))
                named = _renamed(named, renames[-1], "component")
            release_shuffles(docs.sparkSession)
        classes = nodes.join(labels, "node", "left").select("bag", component.alias("class"))
        for names in renames:
            classes = _renamed(classes, names, "class")
        classes = stored(classes, "named-bags")
        members = keep(rows.select("row", "doc_id", "mark", "bag").join(classes, "bag"), "members")
        first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
        sizes = members.groupBy("class").agg(first.alias("first"), F.count("*").alias("class_size"))
        texts = classes.groupBy("class").agg(F.count("*").alias("n_texts"))
        sizes = keep(sizes.join(texts, "class"), "classes")
    return members.join(sizes, "class").select(
        "doc_id", F.col("first.doc_id").alias("class_id"), "class_size", "n_texts",
        (F.col("row") == F.col("first.row")).alias("kept"), "mark")

