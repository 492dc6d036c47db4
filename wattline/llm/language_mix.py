"""Operator 3: language identification as multilingual mixture inference.

Language models are character trigram likelihoods of words, learned from a
bounded seeded sample of labelled documents. A document's units (runs of
``UNIT_WORDS`` words) are drawn from a mixture of languages: expectation-
maximisation estimates its proportions, and languages are removed one by one
as long as that lowers the penalised likelihood (Bayesian information
criterion). The largest proportion of the selected set is the prediction.

Nulls: a null text, or one without a letter, is ``und`` with score 0. A null
lang is never learned from; a null doc_id is never held out nor learned from.
A text of a language that wasn't learned gets the learned one that suits it
best; ``keep_identified`` rejects it. Equal proportions go to the language first by code point. An empty table gives
an empty result; without anything to learn from all is ``und``.
"""
from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.llm.common import per_process, small_batches, stored, unit_hash
from wattline.llm.token_files import slices

UNKNOWN = "und"
#: Labelled documents (expected number) to learn from, per language.
SAMPLE_DOCS = 1500
#: Consecutive words that share one hidden language.
UNIT_WORDS = 4
ITERATIONS = 12
SMOOTHING = 0.5
CACHE_ENTRIES = 200_000
#: The pipeline rejects a text none of whose languages holds this share.
LEAST_SHARE = 0.3
#: A text of fewer trigrams (some 35 words) is never rejected for their likelihood: a few names, links or a license line weigh too much in it.
LEAST_TRIGRAMS = 200
#: Lowest part of the labelled documents by likelihood; a language's floor lies below it by as much as it lies below the
#: median, and by FLOOR_GAP (log likelihood a trigram) at least.
FLOOR_PART, FLOOR_GAP = 0.01, 1.0
WORD = re.compile(r"[^\W\d_]+")


def held_out(key: str = "doc_id") -> Column:
    """Whether a document is never learned from: crc32 of its id as text has remainder 0 by 5."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def words(text: str) -> list[str]:
    """Lower-case runs of letters; marks such as superscripts alone aren't words."""
    found = WORD.findall(text.lower())
    return found if text.isascii() else [w for w in found if any(map(str.isalpha, w))]


def trigrams(word: str) -> list[str]:
    padded = f" {word} "
    return [padded[i:i + 3] for i in range(len(padded) - 2)]


@dataclass
class LanguageModel:
    languages: list[str]
    grams: dict[str, int]
    table: np.ndarray  # log likelihood of each trigram (the last row: any other) by language

    def word(self, word: str) -> np.ndarray:
        unseen = len(self.table) - 1
        return self.table[[self.grams.get(g, unseen) for g in trigrams(word)]].sum(0)


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}
    held: dict[str, Counter] = {}

    def spend(lang: str) -> None:
        into = counts.setdefault(lang, Counter())
        for word, n in held.pop(lang).items():
            for g in trigrams(word):
                into[g] += n
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seen = held.setdefault(lang, Counter())
            seen.update(words(text))
            if len(seen) > CACHE_ENTRIES:
                spend(lang)
    for lang in list(held):
        spend(lang)
    rows = [(lang, g, n) for lang, c in counts.items() for g, n in c.items()]
    if rows:
        lang, gram, n = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(gram), pa.array(n, pa.int64())], ["lang", "gram", "n"])


def _labelled(key: str, text: str, lang: str) -> Column:
    """Whether a document may be learned from."""
    return F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull() & ~held_out(key)


def _sample(docs: DataFrame, sample_docs: int | None, key: str, text: str, lang: str, seed: int) -> DataFrame:
    """(lang, doc_id, text) of the labelled, not held-out documents: all, or a bounded seeded sample of each language."""
    known = docs.where(_labelled(key, text, lang)) \
        .select(F.col(key).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    if sample_docs is None:
        return known
    sizes = known.groupBy("lang").agg(F.count("*").alias("docs"))
    return known.join(F.broadcast(sizes), "lang").where(unit_hash(seed, "doc_id") < F.lit(float(sample_docs)) / F.col("docs"))


def fit(docs: DataFrame, sample_docs: int | None = SAMPLE_DOCS, key: str = "doc_id", text: str = "text", lang: str = "lang",
        seed: int = 3) -> LanguageModel:
    """Trigram likelihoods of each language from the sample, or from all labelled documents (``sample_docs`` None).

    Only the trigram counts reach the driver: they grow with the alphabets, not with the texts.
    """
    small_batches(docs.sparkSession)
    picked = _sample(docs, sample_docs, key, text, lang, seed)
    counts = picked.select("lang", "text").mapInArrow(_count_rows, "lang string, gram string, n long") \
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counts["lang"].unique())
    grams = {g: i for i, g in enumerate(sorted(counts["gram"].unique()))}
    table = np.full((len(grams) + 1, len(languages)), SMOOTHING)
    at = counts["gram"].map(grams).to_numpy(dtype=int), counts["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(dtype=int)
    table[at] += counts["n"].to_numpy(dtype=float)
    return LanguageModel(languages, grams, np.log(table / table.sum(0)) if languages else table)


def floors_of(found: DataFrame) -> dict[str, float]:
    """The floor of each language, from all labelled texts (``__labelled``) that were identified as it."""
    deep = found.where(F.col("__labelled") & (F.col("__trigrams") >= LEAST_TRIGRAMS))
    rows = deep.groupBy("__lang").agg(F.percentile_approx("__depth", [FLOOR_PART, 0.5], 10_000).alias("q")).collect()
    return {r["__lang"]: r["q"][0] - max(r["q"][1] - r["q"][0], FLOOR_GAP) for r in rows}


# --- mixture inference --------------------------------------------------------

def _em(like: np.ndarray, starts: np.ndarray, owner: np.ndarray, n: np.ndarray, allowed: np.ndarray,
        iterations: int = ITERATIONS) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log likelihoods of all documents at once.

    ``like``: each unit's likelihoods, scaled to a maximum of 1; ``owner``: its
    document; ``allowed``: the languages that each document may use.
    """
    share = allowed / allowed.sum(1, keepdims=True)
    for _ in range(iterations):
        weighted = like * share[owner]
        weighted /= weighted.sum(1, keepdims=True)
        share = np.add.reduceat(weighted, starts, axis=0) / n[:, None]
    fit_ = np.add.reduceat(np.log((like * share[owner]).sum(1)), starts)
    return share, fit_


def infer(units: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shares in the selected set, shares among all languages) of documents with n > 0 units each.

    ``units``: log likelihood of each unit by language, document by document.
    """
    like = np.maximum(np.exp(units - units.max(1, keepdims=True)), 1e-30)
    starts = np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64)
    owner = np.repeat(np.arange(len(n)), n)
    allowed = np.ones((len(n), units.shape[1]))
    full, best = _em(like, starts, owner, n, allowed)
    share = full
    cost = np.log(np.maximum(n, 2))  # of one more proportion, on the scale of twice the log likelihood
    active = np.arange(len(n))
    while units.shape[1] > 1 and active.size:
        least = np.where(allowed[active] > 0, share[active], np.inf).argmin(1)
        trial = allowed[active].copy()
        trial[np.arange(active.size), least] = 0
        keep = np.isin(owner, active) if active.size < len(n) else np.ones(len(owner), bool)
        sub_n = n[active]
        new_share, new_fit = _em(like[keep], np.concatenate([[0], np.cumsum(sub_n)[:-1]]).astype(np.int64),
                                 np.repeat(np.arange(active.size), sub_n), sub_n, trial)
        better = 2 * (best[active] - new_fit) <= cost[active]
        rows = active[better]
        allowed[rows], best[rows] = trial[better], new_fit[better]
        share = share.copy()
        share[rows] = new_share[better]
        active = rows[allowed[rows].sum(1) > 1]
    return share, full


class Identifier:
    def __init__(self, model: LanguageModel):
        self.model, self.cache = model, {}
        self.rows = np.zeros((1 << 16, len(model.languages)))

    def _ids(self, flat: list[str]) -> np.ndarray:
        if len(self.cache) > CACHE_ENTRIES:
            self.cache = {}
        cache = self.cache
        ids = list(map(cache.get, flat))
        if None in ids:
            for k, i in enumerate(ids):
                if i is None:
                    i = cache.get(flat[k])
                    if i is None:
                        i = cache[flat[k]] = len(cache)
                        if i >= len(self.rows):
                            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
                        self.rows[i] = self.model.word(flat[k])
                    ids[k] = i
        return np.array(ids, dtype=np.int64)

    def identify(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, list[list[str]], np.ndarray, np.ndarray]:
        """Predicted language, score, largest share, selected set, trigrams and their mean log likelihood, of each text.

        The likelihood is each unit's in the language of the set that suits it best.
        """
        count = len(self.model.languages)
        found = [words(t) if count else [] for t in texts]
        n_words = np.array([len(w) for w in found], dtype=np.int64)
        some = np.flatnonzero(n_words)
        lang, sets = [UNKNOWN] * len(texts), [[] for _ in texts]
        score, top = np.zeros(len(texts)), np.zeros(len(texts))
        size, depth = np.zeros(len(texts), np.int64), np.zeros(len(texts))
        if some.size:
            rows = self.rows_of([w for f in found for w in f])
            n_words = n_words[some]
            n = -(-n_words // UNIT_WORDS)
            word_starts = np.concatenate([[0], np.cumsum(n_words)[:-1]])
            unit_starts = np.concatenate([s + np.arange(0, k, UNIT_WORDS) for s, k in zip(word_starts, n_words)])
            units = np.add.reduceat(rows, unit_starts, axis=0)
            share, full = infer(units, n)
            pick = share.argmax(1)
            at = np.arange(some.size)
            top[some] = share[at, pick]
            score[some] = (n * np.minimum(full[at, pick], share[at, pick]) + 0.5) / (n + 0.5 * count)
            size[some] = [sum(map(len, found[i])) for i in some]
            suited = np.where(np.repeat(share > 1e-9, n, axis=0), units, -np.inf).max(1)
            depth[some] = np.add.reduceat(suited, np.cumsum(n) - n) / size[some]
            for k, row in enumerate(some):
                lang[row] = self.model.languages[pick[k]]
                sets[row] = [self.model.languages[j] for j in np.flatnonzero(share[k] > 1e-9)]
        return lang, score, top, sets, size, depth

    def rows_of(self, flat: list[str]) -> np.ndarray:
        ids = self._ids(flat)
        return self.rows[ids]


def _identify_rows(model: LanguageModel, text_at: int, keep: list[int]):
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identifier = per_process("identifier", name, lambda: Identifier(model))
        for batch in batches:
            lo = 0
            for texts in slices([t or "" for t in batch.column(text_at).to_pylist()]):
                lang, score, top, sets, size, depth = identifier.identify(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(lo, len(texts)) for k in keep]
                    + [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(top, pa.float64()),
                       pa.array(sets, pa.list_(pa.string())), pa.array(size), pa.array(depth)],
                    [batch.schema.names[k] for k in keep] + [f.split()[0] for f in _FOUND.split(", ")])
                lo += len(texts)
    return run


_FOUND = "__lang string, __score double, __share double, __set array<string>, __trigrams long, __depth double"


def identify(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, share, languages."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), held_out(key).alias("held_out"), F.col(text).alias("text"))
    found = rows.mapInArrow(_identify_rows(model, 2, [0, 1]), f"doc_id long, held_out boolean, {_FOUND}")
    return found.select("doc_id", "held_out", F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"),
                        F.col("__share").alias("share"), F.col("__set").alias("languages"))


def keep_identified(docs: DataFrame, model: LanguageModel, text: str = "text", key: str = "doc_id", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` (all columns) whose texts aren't rejected; no shuffle.

    A text is rejected if it has no letter, if its largest share is below
    LEAST_SHARE, or if it is in none of the learned languages: its trigrams are
    less likely than the floor of the language that suits it best, which is set
    from all labelled documents (``floors_of``). The rows are stored with what
    was found, so each text is identified once, for the floors and for itself.
    """
    small_batches(docs.sparkSession)
    names = docs.columns
    plain = docs.select("*", _labelled(key, text, lang)).toDF(*[f"c{i}" for i in range(len(names))], "__labelled")
    fields = T.StructType(plain.schema.fields + T._parse_datatype_string(_FOUND).fields)
    run = _identify_rows(model, names.index(text), list(range(len(names) + 1)))
    found = stored(plain.mapInArrow(run, fields), "identified")
    floors = floors_of(found)
    known = found.where(~rejected("__lang", "__share"))
    if floors:
        floor = F.create_map(*[F.lit(x) for pair in floors.items() for x in pair])[F.col("__lang")]
        known = known.where(~F.coalesce((F.col("__trigrams") >= LEAST_TRIGRAMS) & (F.col("__depth") < floor), F.lit(False)))
    return known.select(*plain.columns[:-1]).toDF(*names)


def rejected(lang: str = "lang_pred", share: str = "share") -> Column:
    """Whether no language holds a text: it has no letter, or its largest share is below LEAST_SHARE."""
    return (F.col(lang) == UNKNOWN) | (F.col(share) < LEAST_SHARE)
