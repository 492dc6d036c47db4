"""Operator 4: token ids in Parquet list columns.

Every whole text is encoded with a public ``tokenizers`` file, the end id is
appended, and ids are written in ascending doc_id order as one list column next
to small metadata columns. The files are made for selective reads:

* ids are dictionary encoded (a vocabulary fits in one dictionary page, so an
  id takes its bit width), ``doc_id`` and ``first`` are delta encoded;
* row groups and pages are small and bounded, and Parquet's page indexes
  (written with the files) let a reader with a filter on ``doc_id`` skip pages;
* a reader that selects metadata never touches the ids.

Texts are encoded a pre-token at a time (byte-level BPE never merges across
them) through a bounded cache that lives as long as the worker process. The
splitter below is used only for texts whose characters it surely classifies as
the library does (ASCII and Latin letters); every other text goes to the
library whole.

Nulls: a null text is empty and holds the end id alone; a null doc_id sorts
first. Repeated doc_ids follow each other, ordered by the hash of their texts.
An empty table gives an empty result.
"""
from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattline.llm.common import per_process, scratch, small_batches, text_or_empty

#: Pre-tokens that each half of a worker's cache may hold.
CACHE_ENTRIES = 250_000
#: Characters of text that a worker handles at a time, and that the encoder does (more: fewer repeats of a pre-token).
SLICE_CHARS = 1_000_000
ENCODED_CHARS = 3_000_000
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 64 << 10
PAGE_ROWS = 1_000


#: Characters that the splitter below surely classifies as the library does; a text with any other goes there whole.
_OTHER = re.compile("[^\t\n\r\x20-\x7e\u00a1-\u024f]")
_CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
_SPACE, _LETTER, _DIGIT, _SIGN = range(4)
_KINDS = np.array([_SPACE if chr(c).isspace() else {"L": _LETTER, "N": _DIGIT}.get(unicodedata.category(chr(c))[0], _SIGN)
                   for c in range(0x250)], dtype=np.uint8)


def split_plain(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """All pre-tokens of texts of plain characters, and how many each text has.

    Byte-level BPE's published rule (``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+|
    ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``) on arrays of characters: a pre-token is a run of
    one kind; a space before a run of another kind belongs to it; of white space
    before such a run the last character stands apart from the others.
    """
    whole = "".join(texts)
    n = np.array([len(t) for t in texts], dtype=np.int64)
    chars = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    size = len(chars)
    if not size:
        return pa.array([], pa.string()), np.zeros(len(texts), np.int64)
    first = np.zeros(size + 1, bool)
    bounds = np.concatenate([[0], np.cumsum(n)])
    first[bounds] = True
    kind = _KINDS[chars]
    start = first[:-1].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # Places whose predecessor, in the same text, is white space while they aren't.
    after = np.flatnonzero((kind[1:] != _SPACE) & (kind[:-1] == _SPACE) & ~first[1:-1]) + 1
    start[after - 1] = True
    start[after[chars[after - 1] == 32]] = False
    # Contractions: an apostrophe that begins a pre-token, and the letters that belong to it.
    mark = np.flatnonzero((chars == 39) & start)
    if mark.size:
        ahead = np.concatenate([chars, np.zeros(2, np.uint32)])
        inside = np.concatenate([~first[1:], [False]])  # whether the next character is of the same text
        one, two = ahead[mark + 1], ahead[mark + 2]
        next_in = inside[mark]
        second_in = next_in & inside[np.minimum(mark + 1, size)]
        short = next_in & np.isin(one, [ord(c) for c in "stmd"])
        long = second_in & (((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e")))
                            | ((one == ord("l")) & (two == ord("l"))))
        start[(mark + 1)[short | long]] = False
        ends = np.concatenate([mark[short] + 2, mark[long] + 3])
        start[ends[ends < size]] = True
    at = np.flatnonzero(start)
    wide = np.concatenate([[0], np.cumsum(chars >= 0x80)])  # such characters take two bytes
    offsets = np.concatenate([at + wide[at], [size + wide[size]]]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(whole.encode()))
    return words, np.diff(np.searchsorted(at, bounds))


def gather(place: np.ndarray, lengths: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the runs named by ``place``, one after another, and where each run ends (from 0 on).

    ``lengths``: the runs' lengths; ``values``: all runs in order.
    """
    n = lengths[place]
    ends = np.concatenate([[0], np.cumsum(n)])
    at = np.repeat((np.cumsum(lengths) - lengths)[place] - ends[:-1], n) + np.arange(int(ends[-1]))
    return values[at], ends


class TextEncoder:
    """Texts to ids, with the end id appended; pre-tokens' ids are cached as little-endian 32-bit bytes."""

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.end = end_id
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)  # the cache below makes the library's own one useless
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, text: str) -> bool:
        return (text.isascii() and not _CONTROL.search(text) or not _OTHER.search(text)) \
            and not any(a in text for a in self.added)

    def _ids(self, words: list[str]) -> list[bytes]:
        """Ids of different pre-tokens, from the cache or else the library."""
        ids = list(map(self.cache.get, words))
        missing = [w for w, i in zip(words, ids) if i is None]
        if missing:
            found = {w: self.older[w] for w in missing if w in self.older}
            new = [w for w in missing if w not in found]
            for lo in range(0, len(new), 10_000):
                found.update(zip(new[lo:lo + 10_000], self._library(new[lo:lo + 10_000])))
            ids = [found[w] if i is None else i for w, i in zip(words, ids)]
            self.cache.update(found)
            if len(self.cache) > CACHE_ENTRIES:  # what is used again soon moves from the older half
                self.older, self.cache = self.cache, {}
        return ids

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each text (how many) and all ids in order.

        Pre-tokens are reduced to different ones, whose ids are then gathered.
        """
        plain = [True] * len(texts) if self._plain("\n".join(texts)) else [self._plain(t) for t in texts]
        words, n_words = split_plain([t for t, p in zip(texts, plain) if p])
        coded = words.dictionary_encode()
        ids = self._ids(coded.dictionary.to_pylist())
        lengths = np.array([len(i) // 4 for i in ids], dtype=np.int64)
        found, ends = gather(coded.indices.to_numpy(zero_copy_only=False), lengths,
                             np.frombuffer(b"".join(ids), "<u4").view("<i4"))
        n = np.diff(ends[np.concatenate([[0], np.cumsum(n_words)])])
        if not all(plain):
            parts, own = iter(np.split(found, np.cumsum(n)[:-1])), self._library([t for t, p in zip(texts, plain) if not p])
            other = (np.frombuffer(i, "<u4").view("<i4") for i in own)
            rows = [next(parts) if p else next(other) for p in plain]
            n, found = np.array([len(r) for r in rows], dtype=np.int64), np.concatenate(rows)
        return n + 1, np.insert(found, np.cumsum(n), self.end)


def slices(texts: list[str], chars: int = SLICE_CHARS) -> Iterator[list[str]]:
    """Runs of texts of about ``chars`` characters at most, or one longer text."""
    part, held = [], 0
    for t in texts:
        if part and held + len(t) > chars:
            yield part
            part, held = [], 0
        part.append(t)
        held += len(t)
    if part:
        yield part


def _encode_rows(tokenizer_path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = per_process("encoder", f"{tokenizer_path} {end_id}", lambda: TextEncoder(tokenizer_path, end_id))
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, lo = batch.column(0), 0
            for texts in slices(batch.column(1).to_pylist(), ENCODED_CHARS):
                lengths, values = encoder.encode(texts)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.array(values))
                first = before + np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
                before += int(lengths.sum())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, len(texts)), pa.array(np.full(len(texts), part, np.int32)), pa.array(first),
                     pa.array(lengths), lists], ["doc_id", "part", "first", "n_tokens", "ids"])
                lo += len(texts)
    return run


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, key: str = "doc_id",
                      text: str = "text") -> None:
    """Encode all texts and write them below ``path`` in ascending order of ``key``.

    Columns: doc_id, part (the file's place in the order), first (ids of the
    same file before the row), n_tokens, ids.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    # Texts only matter for the order where an id repeats; without such ids none is hashed, and the ranges come from ids alone.
    repeats = not rows.groupBy("doc_id").count().where("count > 1").isEmpty()
    order = ["doc_id", F.xxhash64("text")] if repeats else ["doc_id"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    encoded = ordered.mapInArrow(_encode_rows(tokenizer_path, end_id),
                                 "doc_id long, part int, first long, n_tokens long, ids array<int>")
    (encoded.write.option("compression", "snappy").option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.enable.dictionary", "true").option("parquet.enable.dictionary#doc_id", "false")
     .option("parquet.enable.dictionary#first", "false")
     .option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", PAGE_BYTES)
     .option("parquet.page.row.count.limit", PAGE_ROWS).parquet(path))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("doc_id long, part int, first long, n_tokens long, ids array<int>").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, part, start, n_tokens: metadata columns only, ``start`` counted over all files.

    The window runs over one row per file.
    """
    files = read_token_files(spark, path).select("doc_id", "part", "first", "n_tokens")
    return files.join(_file_starts(spark, path), "part").select(
        "doc_id", "part", "first", (F.col("before") + F.col("first")).alias("start"), "n_tokens")


def _file_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, before): the ids in all files before each, from one column."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return read_token_files(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def _crc_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        at, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
        crc = [zlib.crc32(values[a:b]) for a, b in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), batch.column("first"),
             pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())],
            ["doc_id", "part", "first", "n_tokens", "ids_crc32"])


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files."""
    rows = read_token_files(spark, path).select("doc_id", "part", "first", "ids").mapInArrow(
        _crc_rows, "doc_id long, part int, first long, n_tokens long, ids_crc32 long")
    return rows.join(_file_starts(spark, path), "part").select("doc_id", (F.col("before") + F.col("first")).alias("start"),
                                                               "n_tokens", "ids_crc32")


def token_output(docs: DataFrame, tokenizer_path: str, end_id: int = 0, path: str | None = None) -> DataFrame:
    """Write the files (to a new shared folder unless ``path`` is given) and digest them."""
    spark = docs.sparkSession
    path = path or scratch(spark, "token-files")
    write_token_files(docs, path, tokenizer_path, end_id)
    return token_digests(spark, path)
