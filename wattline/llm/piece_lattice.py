"""Operator 9: SentencePiece encoding and decoding on a relational lattice.

Texts are cut into units at places that no piece of the model spans; the
different units of the corpus make one table. Its bounded-length substrings are
exploded, equi-joined to the piece table and grouped by unit: these edges are
the unit's lattice. A fold with Spark's higher-order ``aggregate`` then picks the
path, kept as the unit's boundaries:

* for a unigram model, Viterbi: the path with the largest sum of scores;
* for a BPE model, the model's own merges: the best-scored edge that joins two
  neighbouring symbols, leftmost first, until none is left. Viterbi over BPE
  scores (they are merge ranks) would give other ids than the model's.

Units go back to their texts in two ways: at most ``HOT_UNITS`` that are frequent
in a seeded sample of texts through a broadcast dictionary of that bounded size,
all others by chunk: texts are dealt to chunks of about ``CHUNK_BYTES`` by a hash of
their rows, once, and each chunk's rare units and their ids meet its texts in a
cogroup. Ids equal the library's.

Characters outside the model become its byte pieces. Decoding looks pieces up,
joins bytes, and turns the word mark into spaces again.

Nulls: a null or empty text has no ids. Repeated rows are encoded alike; rows equal
in every column share a chunk. Units of any length have a lattice: those of more than
``LONGEST`` characters are first cut between neighbours that stand together in no
piece, and what stays longer is folded over an array of masks. An empty table gives
an empty result.
"""
from __future__ import annotations

import itertools
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import HASH_GROUPS, per_process, small_batches, stored, temporaries, text_or_empty, unit_hash
from wattline.llm.token_files import gather, slices

MARK = "▁"
#: Units in the broadcast dictionary (each of at most LONGEST characters).
HOT_UNITS = 200_000
#: Characters of a unit whose boundaries fit one 64-bit mask; longer units have a mask for every so many characters.
LONGEST = 60
#: Groups that a task's hash aggregate keeps while it builds lattices.
HELD_UNITS = 160_000
#: Bytes of text in a chunk, about: the texts that one Python group holds.
CHUNK_BYTES = 8 << 20
#: Chunks a shuffle task reads on large inputs.
CHUNKS_PER_TASK = 16
#: Texts (expected number) among which frequent units are looked for.
SAMPLE_DOCS = 15_000
#: Different units that a worker holds before it passes them on.
COUNTED = 100_000
#: The byte between a unit and its ids.
UNIT_END = b"\xff"
BPE, UNIGRAM = 2, 1
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
#: Texts of other characters than these are cut at word marks only.
_OTHER = re.compile(f"[^\t\n\r\x20-\x7e¡-ɏ{MARK}]")
_FINE = re.compile(rf"{MARK}*[{_LETTER}]+|{MARK}*[^{_LETTER}{MARK}\n]+|{MARK}+|\n")
_COARSE = re.compile(rf"{MARK}*[^{MARK}]+|{MARK}+")
#: Kinds of the characters that ``_FINE`` cuts, by code point; the mark, the only one above them, is the last.
_IS_MARK, _IS_LETTER, _IS_LINE, _IS_SIGN = range(4)
_KINDS = np.array([_IS_LINE if c == 10 else _IS_LETTER if re.match(f"[{_LETTER}]", chr(c)) else _IS_SIGN
                   for c in range(0x250)] + [_IS_MARK], dtype=np.uint8)


@dataclass
class PieceModel:
    """Pieces of a SentencePiece model: ids and scores of normal ones, ids of bytes, and all pieces in id order."""
    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: list[int]
    pieces: list[str]
    kind: int
    unknown: int
    fine: bool
    coarse: bool
    together: frozenset[str]

    @property
    def longest(self) -> int:
        return max(map(len, self.ids), default=1)

    def units(self, text: str) -> list[str]:
        """The escaped text, cut where no piece can span."""
        if not text:
            return []
        escaped = MARK + text.replace(" ", MARK)
        if self.fine and not _OTHER.search(text):
            units = _FINE.findall(escaped)
        else:
            units = _COARSE.findall(escaped) if self.coarse else [escaped]
        if max(map(len, units)) <= LONGEST:
            return units
        return [part for u in units for part in (self.parts(u) if len(u) > LONGEST else [u])]

    def parts(self, unit: str) -> list[str]:
        """The unit cut between neighbours that stand together in no piece."""
        ends = [i for i in range(1, len(unit)) if unit[i - 1:i + 1] not in self.together] + [len(unit)]
        return [unit[lo:hi] for lo, hi in zip([0] + ends, ends)]

    def fallback(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode("utf-8", "replace")] if self.byte_ids else [self.unknown]

    def segment_ids(self, unit: str, ends: Iterable[int]) -> bytes:
        """Ids (16 bits each) of a unit's segments, given where they end."""
        out, lo = [], 0
        for hi in ends:
            piece = unit[lo:hi]
            known = self.ids.get(piece)
            if known is not None:
                out.append(known)
            else:
                for c in piece:
                    out.extend(self.fallback(c))
            lo = hi
        return np.array(out, "<u2").tobytes()


def mask_ends(masks: list[int], n: int) -> list[int]:
    """The boundaries after the first one, from masks of LONGEST characters each (a single mask holds one bit more)."""
    if len(masks) == 1:
        ends, rest = [], masks[0] & -2
        while rest:
            low = rest & -rest
            ends.append(low.bit_length() - 1)
            rest ^= low
        return ends
    return [i for k, m in enumerate(masks) for i in range(max(1, k * LONGEST), min(n, k * LONGEST + LONGEST - 1) + 1)
            if m >> (i - k * LONGEST) & 1]


def split_fine(texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All units that ``_FINE`` finds in texts of its characters, how many each text has, and the texts with a unit above LONGEST.

    On arrays of characters: a unit is a run of letters or of signs with the
    marks before it, a run of marks before anything else, or a line feed.
    """
    escaped = [MARK + t.replace(" ", MARK) if t else "" for t in texts]
    whole = "".join(escaped)
    bounds = np.concatenate([[0], np.cumsum(np.array([len(t) for t in escaped], dtype=np.int64))]).astype(np.int64)
    chars = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    if not len(chars):
        return pa.array([], pa.string()), np.zeros(len(texts), np.int64), np.zeros(0, np.int64)
    kind = _KINDS[np.minimum(chars, 0x250)]
    start = np.ones(len(chars), bool)
    attached = (kind[:-1] == _IS_MARK) & (kind[1:] != _IS_LINE)
    start[1:] = (kind[1:] == _IS_LINE) | ((kind[1:] != kind[:-1]) & ~attached)
    start[bounds[bounds < len(chars)]] = True
    at = np.flatnonzero(start)
    bytes_before = np.concatenate([[0], np.cumsum(1 + (chars >= 0x80) + (chars >= 0x800), dtype=np.int64)])
    offsets = bytes_before[np.concatenate([at, [len(chars)]])].astype(np.int32)
    units = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(whole.encode()))
    too_long = at[np.diff(np.concatenate([at, [len(chars)]])) > LONGEST]
    return units, np.diff(np.searchsorted(at, bounds)), np.unique(np.searchsorted(bounds, too_long, side="right") - 1)


def all_units(model: PieceModel, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The units of texts in order (``PieceModel.units`` of each), and how many each text has."""
    plain = np.array([model.fine and not _OTHER.search(t) for t in texts], dtype=bool)
    units, n_plain, too_long = split_fine([t for t, p in zip(texts, plain) if p])
    if len(too_long):
        plain[np.flatnonzero(plain)[too_long]] = False
        units, n_plain, _ = split_fine([t for t, p in zip(texts, plain) if p])
    if plain.all():
        return units, n_plain
    others = [model.units(t) for t, p in zip(texts, plain) if not p]
    n, first = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    n[plain], n[~plain] = n_plain, [len(u) for u in others]
    first[plain] = np.cumsum(n_plain) - n_plain
    first[~plain] = len(units) + np.cumsum(n[~plain]) - n[~plain]
    every = pa.concat_arrays([units, pa.array(itertools.chain.from_iterable(others), pa.string())])
    at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    return every.take(pa.array(at)), n


def unit_codes(model: PieceModel, texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different units of texts, each text's units as places among them, and how many each text has."""
    units, n = all_units(model, texts)
    coded = units.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), n


def cut_safely(pattern: re.Pattern, pieces: list[str]) -> bool:
    """Whether the pattern never cuts inside a piece."""
    return all(pattern.findall(p) == [p] for p in pieces)


def load_model(path: str) -> PieceModel:
    """Read a model file; models with a dummy prefix, escaped spaces and no text normalisation are taken."""
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    norm = proto.normalizer_spec
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not (norm.add_dummy_prefix and norm.escape_whitespaces):
        raise ValueError("this model normalises texts in a way that isn't supported")
    return piece_model([(p.piece, p.score, p.type) for p in proto.pieces], proto.trainer_spec.model_type)


def piece_model(rows: list[tuple[str, float, int]], kind: int) -> PieceModel:
    """A model from (piece, score, type) in id order; types: 1 normal, 2 unknown, 3 control, 6 byte."""
    if len(rows) >= 1 << 16:
        raise ValueError("ids must fit 16 bits")
    normal = {p: i for i, (p, _, t) in enumerate(rows) if t == 1}
    if kind == BPE and max(map(len, normal), default=1) > LONGEST:
        raise ValueError(f"pieces of a BPE model must have at most {LONGEST} characters")
    plain = [p for p in normal if not _OTHER.search(p)]
    return PieceModel(normal, {p: rows[i][1] for p, i in normal.items()}, [i for i, r in enumerate(rows) if r[2] == 6],
                      [r[0] for r in rows], kind, next((i for i, r in enumerate(rows) if r[2] == 2), 0),
                      cut_safely(_FINE, plain), cut_safely(_COARSE, list(normal)),
                      frozenset(p[i:i + 2] for p in normal for i in range(len(p) - 1)))


# --- units of the corpus --------------------------------------------------------

def count_units(docs: DataFrame, model: PieceModel, text: str = "text") -> DataFrame:
    """(unit, n): every different unit of all texts and how often it occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(c: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c.keys(), pa.string()), pa.array(c.values(), pa.int64())], ["unit", "n"])
        counted: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                counted.update(model.units(t))
                if len(counted) > COUNTED:
                    yield rows(counted)
                    counted.clear()
        yield rows(counted)
    units = docs.select(text_or_empty(text).alias("text")).mapInArrow(run, "unit string, n long")
    return units.groupBy("unit").agg(F.sum("n").alias("n"))


# --- lattice and folds ------------------------------------------------------------

def piece_table(spark, model: PieceModel) -> DataFrame:
    """(piece, id, rank, score, late): rank orders pieces by falling score, equal scores alike.

    ``late`` pieces are half of a piece with no worse a rank, so merging one may
    open a merge that comes before it.
    """
    order = {s: r for r, s in enumerate(sorted(set(model.scores.values()), reverse=True))}
    rank = {p: order[s] for p, s in model.scores.items()}
    late = {half for p in rank for k in range(1, len(p)) for half in (p[:k], p[k:]) if rank.get(half, -1) >= rank[p]}
    rows = [(p, i, rank[p], float(model.scores[p]), int(p in late)) for p, i in model.ids.items()]
    return spark.createDataFrame(rows, "piece string, id int, rank long, score double, late int")


def lattice(units: DataFrame, pieces: DataFrame, longest: int, least: int, edge: Column) -> DataFrame:
    """(unit, marks, edges): the pieces of ``least`` or more characters inside each unit (unit, marks) of at most LONGEST.

    Every unit keeps a row: one substring is always emitted, alone carries the marks, and counts as an
    edge only if it is a piece of that length. The grouping reuses a
    partitioning by unit, so exploded substrings never travel.
    """
    n = F.char_length("unit")
    starts = units.select("unit", "marks", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), n - least))).alias("start"))
    first = F.when(F.col("start") == 0, F.lit(1)).otherwise(F.lit(least))
    cuts = starts.select("unit", "marks", "start", F.explode(F.sequence(first, F.least(F.lit(longest), n - F.col("start")))).alias("len"))
    leads = (F.col("start") == 0) & (F.col("len") == 1)
    found = cuts.withColumn("piece", F.substring(F.col("unit"), F.col("start") + 1, F.col("len"))) \
        .join(F.broadcast(pieces), "piece", "left").where(F.col("id").isNotNull() | leads)
    return found.groupBy("unit").agg(
        F.first(F.when(leads, F.col("marks")), ignorenulls=True).alias("marks"),
        F.collect_list(F.when(F.col("id").isNotNull() & (F.col("len") >= least), edge)).alias("edges"))


def long_lattice(units: DataFrame, pieces: DataFrame, longest: int, least: int, edge: Column) -> DataFrame:
    """The lattice of units of any length: substrings are cut from windows, and only a unit's first one carries the unit."""
    windows = units.select("unit", "marks", F.explode(F.transform(
        F.sequence(F.lit(0), F.char_length("unit") - 1, F.lit(LONGEST)),
        lambda at: F.struct(at.alias("base"), F.substring(F.col("unit"), at + 1, F.lit(LONGEST + longest)).alias("part"),
                            F.md5("unit").alias("uid")))).alias("w"))
    leads = F.col("w.base") == 0
    windows = windows.select("w", F.when(leads, F.col("unit")).alias("unit"), F.when(leads, F.col("marks")).alias("marks"))
    n = F.char_length("w.part")
    starts = windows.select("*", F.explode(F.sequence(F.lit(0), F.least(F.lit(LONGEST), n) - 1)).alias("at"))
    cuts = starts.select("*", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), n - F.col("at")))).alias("len"))
    leads = (F.col("w.base") + F.col("at") == 0) & (F.col("len") == 1)
    found = cuts.select(F.col("w.uid").alias("uid"), (F.col("w.base") + F.col("at")).alias("start"), "len",
                        F.when(leads, F.col("unit")).alias("unit"), F.when(leads, F.col("marks")).alias("marks"),
                        F.substring(F.col("w.part"), F.col("at") + 1, F.col("len")).alias("piece")) \
        .join(F.broadcast(pieces), "piece", "left").where(F.col("id").isNotNull() | F.col("unit").isNotNull())
    return found.groupBy("uid").agg(
        F.first("unit", ignorenulls=True).alias("unit"), F.first("marks", ignorenulls=True).alias("marks"),
        F.collect_list(F.when(F.col("id").isNotNull() & (F.col("len") >= least), edge)).alias("edges")).drop("uid")


def bpe_edge() -> Column:
    """An edge as one number that sorts by rank, then start: rank, start (31 bits), length (6 bits), late (1 bit)."""
    return F.shiftleft(F.col("rank").cast("long"), 38) + F.shiftleft(F.col("start").cast("long"), 7) \
        + F.shiftleft(F.col("len").cast("long"), 1) + F.col("late")


def _sl(x: Column, by: Column) -> Column:
    return F.call_function("shiftleft", x, by.cast("int"))


def _sr(x: Column, by: Column) -> Column:
    return F.call_function("shiftright", x, by.cast("int"))


def _span(edge: Column) -> tuple[Column, Column]:
    return F.shiftright(edge, 7).bitwiseAND((1 << 31) - 1), F.shiftright(edge, 1).bitwiseAND(63)


def _joins(at: Column, length: Column) -> Column:
    """Whether boundaries ``at`` (bit i: before character i of the edge) hold exactly two neighbouring symbols."""
    inner = F.shiftright(at, 1).bitwiseAND(_sl(F.lit(1).cast("long"), length - 1) - 1)
    return (at.bitwiseAND(1) + _sr(at, length).bitwiseAND(1) == 2) & (F.bit_count(inner) == 1)


def _merges(mask: Column, edge: Column) -> Column:
    """Whether the edge spans exactly two neighbouring symbols."""
    start, length = _span(edge)
    return _joins(_sr(mask, start), length)


def _merged(mask: Column, edge: Column) -> Column:
    start, length = _span(edge)
    return mask.bitwiseAND(F.bitwise_not(_sl(_sl(F.lit(1).cast("long"), length - 1) - 1, start + 1)))


def fold_merges(edges: Column, n: Column) -> tuple[Column, Column]:
    """Boundaries (bit i: before character i) of a unit of n characters after all merges, in two forms.

    The first applies each of the sorted edges once, in order. That is the
    model's order unless a late piece opens an earlier edge: then it is
    negative, and the second form holds, whose rounds each apply the first edge
    that merges.
    """
    whole = _sl(F.lit(1).cast("long"), n + 1) - 1
    failed = F.lit(-1).cast("long")

    def one(mask, e):
        after = _merged(mask, e)
        opened = (e.bitwiseAND(1) == 1) & F.exists(edges, lambda x: (x < e) & _merges(after, x))
        return F.when((mask < 0) | ~_merges(mask, e), mask).otherwise(F.when(opened, failed).otherwise(after))

    def first(mask, _):
        e = F.try_element_at(F.filter(edges, lambda x: _merges(mask, x)), F.lit(1))
        return F.coalesce(_merged(mask, e), mask)
    once = F.aggregate(edges, whole, one)
    return once, F.aggregate(F.sequence(F.lit(1), n), whole, first)


def _window(masks: Column, start: Column) -> Column:
    """LONGEST + 1 boundaries from ``start`` on, read from an array of masks."""
    at, shift = F.floor(start / LONGEST).cast("int"), start % LONGEST
    after = F.coalesce(F.get(masks, at + 1), F.lit(0).cast("long"))
    return _sr(F.get(masks, at), shift).bitwiseOR(_sl(after, LONGEST - shift)).bitwiseAND((1 << (LONGEST + 1)) - 1)


def fold_long_merges(edges: Column, n: Column) -> Column:
    """Masks of LONGEST boundaries each for a unit of any length, after all merges.

    A round applies the sorted edges in order and stops where a late piece
    has opened an earlier edge; the next one starts again from the first edge.
    """
    full = F.lit((1 << LONGEST) - 1).cast("long")
    whole = F.transform(F.sequence(F.lit(0), F.floor(n / LONGEST).cast("int")), lambda k: F.when(
        k < F.floor(n / LONGEST), full).otherwise(_sl(F.lit(1).cast("long"), n % LONGEST + 1) - 1))

    def merged(masks, e):
        start, length = _span(e)
        at, shift = F.floor(start / LONGEST).cast("int"), start % LONGEST + 1
        inner = _sl(F.lit(1).cast("long"), length - 1) - 1
        here, there = _sl(inner, shift).bitwiseAND(full), _sr(inner, LONGEST - shift)
        return F.transform(masks, lambda m, k: F.when(k == at, m.bitwiseAND(F.bitwise_not(here)))
                           .when(k == at + 1, m.bitwiseAND(F.bitwise_not(there))).otherwise(m))

    def fits(masks, e):
        start, length = _span(e)
        return _joins(_window(masks, start), length)

    def one(state, e):
        start, length = _span(e)
        after = merged(state["masks"], e)

        def opens(x):
            at = _span(x)[0]
            return (x < e) & (at < start + length) & (at > start - LONGEST) & fits(after, x)
        opened = (e.bitwiseAND(1) == 1) & F.exists(edges, opens)
        return F.when(state["ended"] | ~fits(state["masks"], e), state).otherwise(
            F.struct(after.alias("masks"), opened.alias("ended")))

    def once(state, _):
        masks = state["masks"]
        run = F.aggregate(edges, F.struct(masks.alias("masks"), F.lit(False).alias("ended")), one,
                          lambda r: F.struct(r["masks"].alias("masks"), (~r["ended"]).alias("ended")))
        return F.when(state["ended"], state).otherwise(run)
    return F.aggregate(F.sequence(F.lit(1), n), F.struct(whole.alias("masks"), F.lit(False).alias("ended")), once,
                       lambda r: r["masks"])


def fold_viterbi(edges: Column, n: Column) -> tuple[Column, Column]:
    """Best scores with back pointers, and the ends of the best path's segments read from a column ``best`` of them.

    Edges are structs (start, len, score), sorted by start.
    """
    start = F.transform(F.sequence(F.lit(0), n), lambda i: F.struct(
        F.when(i == 0, F.lit(0.0)).otherwise(F.lit(float("-inf"))).alias("score"), F.lit(0).alias("back")))

    def relax(best, e):
        score = best[e["start"]]["score"] + e["score"]
        return F.transform(best, lambda x, i: F.when((i == e["start"] + e["len"]) & (score > x["score"]), F.struct(
            score.alias("score"), e["start"].alias("back"))).otherwise(x))
    best = F.aggregate(edges, start, relax)

    def back(state, _):
        prev = F.col("best")[state["at"]]["back"]
        return F.when(state["at"] == 0, state).otherwise(F.struct(
            prev.alias("at"), F.concat(F.array(state["at"]), state["ends"]).alias("ends")))
    walk = F.aggregate(F.sequence(F.lit(1), n), F.struct(n.alias("at"), F.array().cast("array<int>").alias("ends")),
                       back, lambda s: s["ends"])
    return best, walk


def encode_units(units: DataFrame, model: PieceModel) -> DataFrame:
    """(unit, marks, ids): every different unit (unit, mark) with its marks, null ones left out, and its ids, 16 bits each.

    Units should come partitioned by unit, or they are shuffled for it. Many groups stay
    in a task's hash map (HELD_UNITS); that setting must hold until the caller's action, so it stays set.
    """
    spark = units.sparkSession
    if int(spark.conf.get(HASH_GROUPS)) < HELD_UNITS:
        spark.conf.set(HASH_GROUPS, HELD_UNITS)
    # The length comes from the aggregate, so that a filter on it isn't pushed into what makes the units.
    units = units.groupBy("unit").agg(F.max(F.char_length("unit")).alias("n"), F.collect_list("mark").alias("marks"))
    short, long = units.where(F.col("n") <= LONGEST), units.where(F.col("n") > LONGEST)
    pieces, n = piece_table(spark, model), F.char_length("unit")
    if model.kind == BPE:
        # A generator between two projections keeps the sorted edges from being made anew for every use.
        found = lattice(short, pieces, min(model.longest, LONGEST), 2, bpe_edge())
        found = found.select("unit", "marks", F.explode(F.array(F.sort_array("edges"))).alias("edges"))
        once, rounds = fold_merges(F.col("edges"), n)
        found = found.select("unit", "marks", "edges", F.explode(F.array(once)).alias("mask"))
        paths = found.select("unit", "marks", F.array(F.when(F.col("mask") >= 0, F.col("mask")).otherwise(rounds)).alias("path"))
        found = long_lattice(long, pieces, model.longest, 2, bpe_edge())
        found = found.select("unit", "marks", F.explode(F.array(F.sort_array("edges"))).alias("edges"))
        paths = paths.unionByName(found.select("unit", "marks", fold_long_merges(F.col("edges"), n).alias("path")))
    else:
        # A character outside the model costs more than any piece.
        unknown = min(model.scores.values(), default=0.0) - 10.0
        edge = F.struct("start", "len", "score")
        found = lattice(short, pieces, min(model.longest, LONGEST), 1, edge) \
            .unionByName(long_lattice(long, pieces, model.longest, 1, edge))
        chars = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
            i.alias("start"), F.lit(1).alias("len"), F.lit(unknown).alias("score")))
        found = found.select("unit", "marks", F.explode(F.array(F.array_sort(F.concat("edges", chars)))).alias("edges"))
        best, walk = fold_viterbi(F.col("edges"), n)
        found = found.select("unit", "marks", F.explode(F.array(best)).alias("best"))
        paths = found.select("unit", "marks", walk.cast("array<long>").alias("path"))
    masked = model.kind == BPE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [model.segment_ids(u, mask_ends(path, len(u)) if masked else path)
                   for u, path in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary())], ["unit", "marks", "ids"])
    return paths.mapInArrow(run, "unit string, marks array<long>, ids binary")


# --- texts ------------------------------------------------------------------------

ENCODED = "doc_id long, text string, ids array<int>"
NO_ROWS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("ids", pa.list_(pa.int32()))])


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, chunk, size, packed) from (doc_id, chunk, text): texts compressed one by one, so that their shuffle is small."""
    for batch in batches:
        raw = batch.column(2).cast(pa.binary()).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(map(len, raw), pa.int64(), size=len(raw)),
             pa.array([pa.compress(t, "zstd", asbytes=True) if t else b"" for t in raw], pa.binary())],
            ["doc_id", "chunk", "size", "packed"])


def unpack(batch: pa.RecordBatch) -> list[str]:
    """The texts of packed rows."""
    return [pa.decompress(t, n, "zstd", asbytes=True).decode() if n else ""
            for t, n in zip(batch.column("packed").to_pylist(), batch.column("size").to_pylist())]


def encode(docs: DataFrame, model: PieceModel, key: str = "doc_id", text: str = "text",
           then: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None, schema: str = ENCODED) -> DataFrame:
    """(doc_id, text, ids): whole texts with their ids.

    ``then`` turns each batch of these columns into rows of ``schema`` in the
    same pass, where ids needn't leave their worker.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.xxhash64(*docs.columns).alias("mark"), F.col(key).cast("long").alias("doc_id"),
                       text_or_empty(text).alias("text"))
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    with temporaries(spark):
        some = rows.where(unit_hash(9, "mark") < SAMPLE_DOCS / max(1, n))
        often = count_units(some, model).where((F.col("n") > 1) & (F.char_length("unit") <= LONGEST))
        top = stored(often.orderBy(F.desc("n"), "unit").limit(HOT_UNITS).select("unit"), "hot-units")
        hot = {r["unit"]: bytes(r["ids"]) for r in encode_units(top.withColumn("mark", F.lit(None).cast("long")), model).toLocalIterator()}
    shared = spark.sparkContext.broadcast(hot)
    chunks = max(1, -(-size // CHUNK_BYTES))
    # One shuffle of the texts: the pass that finds rare units and the one that writes ids both read it. With fewer tasks
    # than the session's shuffles have, the cogroup would shuffle them again.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), chunks // CHUNKS_PER_TASK)
    rows = rows.select("doc_id", F.pmod("mark", F.lit(chunks)).alias("chunk"), "text") \
        .mapInArrow(pack, "doc_id long, chunk long, size long, packed binary").repartition(tasks, "chunk")

    def rare_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(list(held), np.int64), [len(u) for u in held.values()])),
                 pa.array(itertools.chain.from_iterable(held.values()), pa.string())], ["mark", "unit"])
            held.clear()
            return out
        known, held = shared.value, {}
        for batch in batches:
            chunks_of, lo = batch.column(1).to_numpy(), 0
            for part in slices(unpack(batch)):
                different, place, n = unit_codes(model, part)
                names, which = np.unique(chunks_of[lo:lo + len(part)], return_inverse=True)
                lo += len(part)
                words = different.to_pylist()
                rare = np.array([w not in known for w in words], dtype=bool)[place] if words else np.zeros(0, bool)
                pairs_of = np.unique(np.repeat(which, n)[rare] * len(words) + place[rare])
                for c, w in zip(names[pairs_of // max(1, len(words))].tolist(), (pairs_of % max(1, len(words))).tolist()):
                    held.setdefault(c, set()).add(words[w])
            if sum(map(len, held.values())) > 10 * COUNTED:
                yield pairs()
        yield pairs()
    # A chunk's unit may come twice, where a worker has passed its units on early.
    rare = rows.mapInArrow(rare_units, "mark long, unit string").repartition(tasks, "unit")
    # One column for a unit and its ids takes less room in the shuffle; no UTF-8 text holds the byte between them.
    coded = encode_units(rare, model).select(F.explode("marks").alias("chunk"), F.concat(
        F.col("unit").cast("binary"), F.lit(UNIT_END), F.col("ids")).alias("coded"))

    def code(texts: pa.Table, own: pa.Table) -> pa.Table:
        get = shared.value.get
        more = {unit.decode(): ids for unit, _, ids in (c.partition(UNIT_END) for c in own["coded"].to_pylist())}
        out = []
        for batch in texts.to_batches():
            lo = 0
            for part in slices(unpack(batch)):
                doc_ids = batch.column("doc_id").slice(lo, len(part))
                lo += len(part)
                different, place, n = unit_codes(model, part)
                ids = [get(u) or more[u] for u in different.to_pylist()]
                lengths = np.array([len(i) // 2 for i in ids], dtype=np.int64)
                found, ends = gather(place, lengths, np.frombuffer(b"".join(ids), "<u2").astype(np.int32))
                at = ends[np.concatenate([[0], np.cumsum(n)])].astype(np.int32)
                coded_rows = pa.RecordBatch.from_arrays(
                    [doc_ids, pa.array(part, pa.string()), pa.ListArray.from_arrays(pa.array(at), pa.array(found))],
                    ["doc_id", "text", "ids"])
                out.append(then(coded_rows) if then else coded_rows)
        return pa.Table.from_batches(out) if out else empty
    empty = then(pa.RecordBatch.from_pylist([], NO_ROWS)) if then else pa.RecordBatch.from_pylist([], NO_ROWS)
    empty = pa.Table.from_batches([empty])
    return rows.groupBy("chunk").cogroup(coded.groupBy("chunk")).applyInArrow(code, schema)


def piece_bytes(model: PieceModel) -> pa.Array:
    """Each id's bytes; control and unknown pieces have none."""
    out = [p.encode() if p in model.ids else b"" for p in model.pieces]
    for b, i in enumerate(model.byte_ids):
        out[i] = bytes([b])
    return pa.array(out, pa.large_binary())


def decode_lists(ids: pa.ListArray, table: pa.Array) -> list[str]:
    """The text of each list of ids: its pieces' bytes as UTF-8, word marks as spaces, the first one dropped."""
    at = ids.offsets.to_numpy().astype(np.int64)
    taken = table.take(ids.values.slice(int(at[0]), int(at[-1] - at[0])))
    ends = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1)
    data, out = taken.buffers()[2], []
    bounds = ends[at - at[0]].tolist()
    raw = data.to_pybytes() if data is not None else b""
    for a, b in zip(bounds, bounds[1:]):
        text = raw[a:b].decode("utf-8", "replace").replace(MARK, " ")
        out.append(text[1:] if text.startswith(" ") else text)
    return out


def decode(encoded: DataFrame, model: PieceModel) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_bytes(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(decode_lists(batch.column(1), table), pa.string())],
                                             ["doc_id", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def _digest(model: PieceModel, with_ids: bool) -> tuple[Callable[[pa.RecordBatch], pa.RecordBatch], str]:
    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column(2)
        table = per_process("pieces", name, lambda: piece_bytes(model))
        at, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
        crc = [zlib.crc32(values[a:b]) for a, b in zip(at[:-1], at[1:])]
        same = [a == b.replace(MARK, " ") for a, b in zip(decode_lists(lists, table), batch.column(1).to_pylist())]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())]
            + [lists] * with_ids, ["doc_id", "n_ids", "ids_crc32", "decoded"] + ["ids"] * with_ids)
    name = uuid.uuid4().hex
    return each, "doc_id long, n_ids long, ids_crc32 long, decoded boolean" + ", ids array<int>" * with_ids


def digest(encoded: DataFrame, model: PieceModel, with_ids: bool = False) -> DataFrame:
    """doc_id, n_ids, ids_crc32 (little-endian 32-bit ids), whether decoding gives the text back, and ids if asked."""
    each, schema = _digest(model, with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(each, batches)
    return encoded.mapInArrow(run, schema)


def encode_and_check(docs: DataFrame, model: PieceModel, with_ids: bool = False) -> DataFrame:
    """The digest of ``encode``, made in the same pass."""
    each, schema = _digest(model, with_ids)
    return encode(docs, model, then=each, schema=schema)
