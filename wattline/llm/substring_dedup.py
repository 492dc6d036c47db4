"""Operator 12: substring dedup by level-wise doubling.

A word is a run of bytes other than the ASCII blanks 0x20 and 0x09-0x0D. A
window of ``WINDOW`` words is repeated if its words also start anywhere else,
in the same text or another. The words of all repeated windows are removed.

Lengths double up to the window's (9, 18, 35 words), and only what is repeated
at one length is extended to the next:

* 9 words: each window is represented by its anchor, the part of 9 words with
  the smallest hash, leftmost if several. Equal windows have equal anchors at
  equal offsets, so a window whose anchor is unique is unique. Consecutive
  windows mostly share an anchor; one row stands for such a run of windows.
* 18 words: an anchor grows to the right for the windows that reach so far,
  and to the left for the others.
* 35 words: the words that a run's windows cover together are its context. If a
  context occurs again, so do all its windows. The windows of the other
  contexts are counted one by one, together with one representative of each
  repeated context, so thousands of copies of a passage are counted once.

The levels end there, since longer repeats remove nothing more, or as soon as
no candidate survives. Contexts and whole windows are compared by 128 bits;
shorter keys (64 bits) only choose candidates.

Scale: every level shuffles only keys of survivors; counts are aggregated on
the map side, and survivors are joined back to unique keys, so adaptive
execution can split a passage that a third of the rows hold. Nothing larger
than one document's own ranges is gathered. A document is named by 128 bits of
its doc_id and text; rows that repeat both are counted as two occurrences.

Nulls: a null text has no words, and its result is the empty text, as for empty
texts and texts of blanks. A null doc_id is a doc_id like others. A text of
fewer than ``WINDOW`` words loses nothing. Of rows that repeat a text of at
least ``WINDOW`` words all lose all words. Texts are never cut; other columns
are ignored. An empty table gives an empty result.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import row_mark, small_batches, stored, temporaries

WINDOW = 35
#: Bytes of text that are hashed at once; a longer text is hashed alone.
SLICE = 1 << 21

_SEEDS = (0x243F6A8885A308D3, 0x13198A2E03707344)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Hashes of words and of runs of words, from prefix sums modulo 2**64."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 1 << 64, 256, dtype=np.uint64)
        # 3 modulo 8 and 5 modulo 8: odd, and so invertible.
        self.byte_base, self.word_base = (int(x) << 3 | low for x, low in zip(rng.integers(0, 1 << 61, 2), (3, 5)))
        self.held: dict[int, np.ndarray] = {}

    def _powers(self, base: int, n: int) -> np.ndarray:
        if len(self.held.get(base, ())) < n:
            powers = np.full(max(n, 1 << 16), base, np.uint64)
            powers[0] = 1
            self.held[base] = np.cumprod(powers, dtype=np.uint64)
        return self.held[base][:n]

    def _runs(self, values: np.ndarray, base: int, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Polynomials of ``values[start:stop]``, the same wherever the run lies."""
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self._powers(base, len(values)), out=sums[1:])
        return (sums[stop] - sums[start]) * self._powers(pow(base, -1, 1 << 64), len(values) + 1)[start]

    def words(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        size = (stop - start).astype(np.uint64)
        return _mixed(self._runs(self.table[data], self.byte_base, start, stop) + size * np.uint64(0x9E3779B97F4A7C15))

    def windows(self, words: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mixed(self._runs(words, self.word_base, start, stop))


def hashers() -> list[Hasher]:
    return [Hasher(seed) for seed in _SEEDS]


def split_words(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, first) of the words in the texts that end at ``ends``; text i has the words first[i] to first[i + 1]."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    before, after = np.ones(len(data), bool), np.ones(len(data), bool)
    before[1:], after[:-1] = blank[:-1], blank[1:]
    begins = np.concatenate([[0], ends[:-1]])
    full = ends > begins
    before[begins[full]] = after[ends[full] - 1] = True
    start, stop = np.flatnonzero(~blank & before), np.flatnonzero(~blank & after) + 1
    return start, stop, np.concatenate([np.searchsorted(start, begins), [len(start)]])


def _least(keys: np.ndarray, span: int) -> np.ndarray:
    """For each run of ``span`` keys the place of its smallest, the leftmost of equal ones."""
    at, size = np.arange(len(keys)), 1
    while size < span:
        step = min(size, span - size)
        left, right = at[:len(at) - step], at[step:]
        at = np.where(keys[right] < keys[left], right, left)
        size += step
    return at


def anchored_runs(first: np.ndarray, keys: np.ndarray, window: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, anchor, lo, hi): runs of windows lo..hi of one text whose smallest key of ``length`` words is at ``anchor``."""
    n = first[-1] - window + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 4
    text = np.searchsorted(first, np.arange(first[-1]), "right") - 1
    valid = text[:n] == text[window - 1:]
    at = _least(keys, window - length + 1)[:n]
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (at[1:] != at[:-1]) | (text[1:n] != text[:n - 1])
    lo = np.flatnonzero(new)
    last = valid.copy()
    last[:-1] &= ~valid[1:] | new[1:]
    return text[lo], at[lo], lo, np.flatnonzero(last)


def _slices(batch: pa.RecordBatch, text: int):
    """(first row, bytes, ends): the texts of a batch in parts of about SLICE bytes; a null text is empty."""
    column = batch.column(text).cast(pa.large_binary())
    buffers = column.buffers()
    at = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(at, at[row] + SLICE, "right")) - 1)
        yield row, data[at[row]:at[stop]], at[row + 1:stop + 1] - at[row]
        row = stop


def _lengths(window: int) -> tuple[int, int]:
    """The two lengths before the window's, halves rounded up."""
    half = -(-window // 2)
    return -(-half // 2), half


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _keys(window: int):
    """key: the hash of every anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, hasher = _lengths(window)[0], Hasher(_SEEDS[0])
        for batch in batches:
            for _, data, ends in _slices(batch, 0):
                start, stop, first = split_words(data, ends)
                words = hasher.words(data, start, stop)
                place = np.arange(max(0, len(words) - length + 1))
                keys = hasher.windows(words, place, place + length)
                at = anchored_runs(first, keys, window, length)[1]
                yield pa.RecordBatch.from_arrays([_signed(keys[at])], ["key"])
    return run


RUN = "mark binary, at int, lo int, hi int, key long, right long, left long, c1 long, c2 long"


def _runs(window: int):
    """One row per anchor: its windows, its key, the keys of its two extensions and its context's 128 bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short, half = _lengths(window)
        both = hashers()
        for batch in batches:
            for row, data, ends in _slices(batch, 1):
                start, stop, first = split_words(data, ends)
                words = [h.words(data, start, stop) for h in both]
                n = len(start)
                place = np.arange(max(0, n - short + 1))
                keys = both[0].windows(words[0], place, place + short)
                text, at, lo, hi = anchored_runs(first, keys, window, short)
                right, left = np.minimum(at, n - half), np.maximum(at + short - half, 0)
                grown = [both[0].windows(words[0], x, x + half) for x in (right, left)]
                # The windows' places around the anchor are part of the context's identity.
                shape = ((at - lo) * (2 * window) + (hi - at)).astype(np.uint64)
                context = [_mixed(h.windows(w, lo, hi + window) + shape) for h, w in zip(both, words)]
                own = first[text]
                marks = batch.column(0).take(pa.array(row + text))
                yield pa.RecordBatch.from_arrays(
                    [marks, *[pa.array((x - own).astype(np.int32)) for x in (at, lo, hi)], _signed(keys[at]),
                     *[_signed(x) for x in grown + context]],
                    ["mark", "at", "lo", "hi", "key", "right", "left", "c1", "c2"])
    return run


def _windows(window: int):
    """(mark, at, h1, h2, single): every window of the given ranges (lo, hi, single) of a text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = hashers()
        for batch in batches:
            spans, bounds = batch.column(2), batch.column(2).offsets.to_numpy() - batch.column(2).offsets[0].as_py()
            lo, hi, single = (spans.flatten().field(i).to_numpy(zero_copy_only=False) for i in range(3))
            for row, data, ends in _slices(batch, 1):
                start, stop, first = split_words(data, ends)
                mine = slice(bounds[row], bounds[row + len(ends)])
                text = np.repeat(np.arange(len(ends)), np.diff(bounds[row:row + len(ends) + 1]))
                size = hi[mine] - lo[mine] + 1
                of = np.repeat(np.arange(len(size)), size)
                place = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + lo[mine][of]
                at = place + first[text[of]]
                h = [x.windows(x.words(data, start, stop), at, at + window) for x in both]
                marks = batch.column(0).take(pa.array(row + text[of]))
                yield pa.RecordBatch.from_arrays([marks, pa.array(place.astype(np.int32)), *map(_signed, h),
                                                  pa.array(single[mine][of])], ["mark", "at", "h1", "h2", "single"])
    return run


def _repeated(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The keys of more than one row."""
    return stored(rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys), name)


def repeated_windows(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(mark, lo, hi): the places (from 0) of repeated windows, in ranges of windows that may touch or overlap."""
    if window < 4:
        raise ValueError("windows need at least 4 words")
    short, half = _lengths(window)
    texts = docs.select(row_mark(key, text).alias("mark"), F.col(text).cast("string").alias("text"))
    nothing = docs.sparkSession.createDataFrame([], "mark binary, lo int, hi int")

    keys = _repeated(texts.select("text").mapInArrow(_keys(window), "key long"), ["key"], "repeated-anchors")
    if keys.isEmpty():
        return nothing
    runs = stored(texts.mapInArrow(_runs(window), RUN).join(keys, "key", "left_semi").drop("key"), "anchors")

    # A window reaches ``half`` words to the right of its anchor if the anchor lies so far from its end.
    edge = F.col("at") - (window - half)
    sides = F.array(F.struct(F.lit(True).alias("rightwards"), F.col("right").alias("key"), F.greatest("lo", edge).alias("lo"), F.col("hi")),
                    F.struct(F.lit(False).alias("rightwards"), F.col("left").alias("key"), F.col("lo"), F.least("hi", edge - 1).alias("hi")))
    grown = runs.select("mark", "c1", "c2", F.explode(sides).alias("s")).select("mark", "c1", "c2", "s.*").where("lo <= hi")
    keys = _repeated(grown, ["rightwards", "key"], "repeated-halves")
    if keys.isEmpty():
        return nothing
    grown = stored(grown.join(keys, ["rightwards", "key"], "left_semi").drop("key"), "halves")

    context = ["c1", "c2", "rightwards"]
    contexts = stored(grown.groupBy(*context).agg(F.count("*").alias("n"), F.min(F.struct("mark", "lo", "hi")).alias("one")), "contexts")
    whole = grown.join(contexts.where("n > 1").select(*context), context, "left_semi").select("mark", "lo", "hi")
    spans = contexts.select("one.*", (F.col("n") == 1).alias("single")).groupBy("mark") \
        .agg(F.collect_list(F.struct("lo", "hi", "single")).alias("spans"))
    each = texts.join(spans, "mark").mapInArrow(_windows(window), "mark binary, at int, h1 long, h2 long, single boolean")
    each = stored(each, "windows")
    # A representative stands for two places at least.
    known = stored(each.groupBy("h1", "h2").agg(F.sum(F.when(F.col("single"), 1).otherwise(2)).alias("n")).where("n > 1")
                   .select("h1", "h2"), "repeated-windows")
    loose = each.where("single").join(known, ["h1", "h2"], "left_semi").select("mark", F.col("at").alias("lo"), F.col("at").alias("hi"))
    return whole.unionByName(loose)


KEPT = "doc_id {kind}, n_words long, n_removed long, text string"


def _without(window: int):
    """Each text without the words of its ranges of windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(1).cast(pa.large_binary()), batch.column(2)
            n_words, n_removed, kept = [], [], []
            for i in range(batch.num_rows):
                words = (texts[i].as_py() or b"").split()
                n_words.append(len(words))
                if spans[i].is_valid:
                    lo, hi = (spans[i].values.field(j).to_numpy() for j in range(2))
                    steps = np.zeros(len(words) + 1, np.int64)
                    np.add.at(steps, lo, 1)
                    np.add.at(steps, hi + window, -1)
                    words = list(compress(words, (np.cumsum(steps[:-1]) == 0).tolist()))
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "text"])
    return run


def dedup_substrings(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, text (the kept words, joined by one space)."""
    spark = docs.sparkSession
    small_batches(spark)
    with temporaries(spark) as keep:
        ranges = repeated_windows(docs, key, text, window).distinct()
        ranges = ranges.groupBy("mark").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
        ranges = keep(ranges, "covered")
    rows = docs.select(row_mark(key, text).alias("mark"), F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.join(ranges, "mark", "left").select("doc_id", "text", "spans").mapInArrow(_without(window), KEPT.format(kind=kind))
