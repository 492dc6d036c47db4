"""Operator 2: toxicity by a linear-chain conditional random field.

Tokens are words. Document labels become token labels on a bounded sample of
labelled documents: a greedy cover picks the words and word beginnings that
tell toxic documents from clean ones, and their tokens are labelled toxic.
A two-state linear-chain CRF is trained on these tokens (features: the word, its
beginnings, the words before and after). On every whole text the forward and
backward recursions give each token's marginal; marginals above
``SPAN_MARGINAL`` form the offending spans, and a logistic function of the
document's marginals, fitted on the same sample, gives its score.

Recursions of a two-state chain are Moebius maps of the ratio of the two states,
so they run over blocks of a flat array of tokens (``chain_scan``); a long
text costs no more per token than short ones.

Nulls: a null or empty text has no tokens and gets the score of a document
without marginals, and no spans. Unlabelled documents and null labels are
scored but not learned from; a label that repeats counts as toxic if any of its
rows does. An empty table gives an empty result; without labels of both kinds
every score is 0.
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

from wattline.llm.common import per_process, small_batches, stored, text_or_empty, unit_hash
from wattline.llm.token_files import slices

#: Labelled texts (expected number) to learn from, per label, and how many bytes of them: whole texts, in a
#: seeded order, until the bytes are spent. A text of any length can be among them.
SAMPLE_DOCS = {0: 1200, 1: 1000}
SAMPLE_BYTES = {0: 3_500_000, 1: 3_000_000}
#: A predicted document scores at least this.
THRESHOLD = 0.7
SPAN_MARGINAL = 0.5
#: Hashed feature space of each feature kind.
SPACE = 1 << 18
PREFIXES = (4, 5, 6)
#: A telling form of this share of the toxic sample is always in the lexicon.
FREQUENT = 0.03
CACHE_ENTRIES = 200_000
EPOCHS = 40
TOKEN = re.compile(r"\w+")


def held_out(key: str = "doc_id") -> Column:
    """Whether a document is never learned from: crc32 of its id as text has remainder 1 by 3."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


# --- chain recursions -------------------------------------------------------

def chain_scan(a, b, c, d) -> np.ndarray:
    """x[t] = (a[t] x[t-1] + b[t]) / (c[t] x[t-1] + d[t]) for all t, with a[0] = c[0] = 0.

    The array is cut into about sqrt(n) blocks: each block's composed map,
    then the values at the blocks' ends, then the values inside, each step over
    all blocks at once.
    """
    n = len(a)
    if n == 0:
        return np.zeros(0)
    width = max(1, int(np.sqrt(n)))
    rows = -(-n // width)
    def block(x, fill):
        return np.concatenate([x, np.full(rows * width - n, fill)]).reshape(rows, width).T.copy()
    a, b, c, d = block(a, 1.0), block(b, 0.0), block(c, 0.0), block(d, 1.0)
    pa_, pb, pc, pd = a[0].copy(), b[0].copy(), c[0].copy(), d[0].copy()
    for t in range(1, width):
        na, nb = a[t] * pa_ + b[t] * pc, a[t] * pb + b[t] * pd
        nc, nd = c[t] * pa_ + d[t] * pc, c[t] * pb + d[t] * pd
        scale = 1.0 / np.maximum(np.maximum(na, nb), np.maximum(nc, nd))
        pa_, pb, pc, pd = na * scale, nb * scale, nc * scale, nd * scale
    start, x = np.empty(rows), 1.0
    for i in range(rows):
        start[i] = x
        x = (pa_[i] * x + pb[i]) / (pc[i] * x + pd[i])
    out = np.empty((width, rows))
    x = start
    for t in range(width):
        x = (a[t] * x + b[t]) / (c[t] * x + d[t])
        out[t] = x
    return out.T.reshape(-1)[:n]


def marginals(emit: np.ndarray, first: np.ndarray, start: float, trans: np.ndarray):
    """Forward and backward ratios and the marginals of state 1.

    ``emit``: log-odds of state 1 of each token; ``first``: whether a token
    begins a document; ``trans``: 2x2 log weights of going from row to column.
    """
    e, w = np.exp(np.clip(emit, -30, 30)), np.exp(trans)
    r = chain_scan(np.where(first, 0.0, e * w[1, 1]), np.where(first, e * np.exp(start), e * w[0, 1]),
                   np.where(first, 0.0, w[1, 0]), np.where(first, 1.0, w[0, 0]))
    last = np.concatenate([first[1:], [True]]) if len(first) else first
    after = np.concatenate([e[1:], [1.0]]) if len(e) else e
    # q[t] from q[t+1], on reversed arrays; a document's last token has ratio 1.
    q = chain_scan(np.where(last, 0.0, w[1, 1] * after)[::-1], np.where(last, 1.0, w[1, 0])[::-1],
                   np.where(last, 0.0, w[0, 1] * after)[::-1], np.where(last, 1.0, w[0, 0])[::-1])[::-1]
    odds = r * q
    return r, q, e, odds / (1.0 + odds)


# --- model ------------------------------------------------------------------

def _hash(text: str, kind: int) -> int:
    return (int.from_bytes(text.encode("utf-8", "replace"), "little") * 0x9E3779B97F4A7C15
            + len(text) * 0x632BE59BD9B4E019 + kind * 0x2545F4914F6CDD1D) % 0xFFFFFFFFFFFFFFC5 % SPACE


def own_features(word: str) -> list[int]:
    """The word and its beginnings; a short word counts as its own beginning."""
    return [_hash(word, 0)] + [_hash(word[:n], n) for n in PREFIXES]


@dataclass
class Crf:
    own: np.ndarray      # SPACE: weights of words and beginnings
    near: np.ndarray     # 2 x SPACE: weights of the word before and after
    bias: float
    start: float
    trans: np.ndarray    # 2 x 2
    doc: np.ndarray      # intercept and weights of the document's features

    def word(self, word: str) -> tuple[float, float, float]:
        """A word's part in the log-odds of itself, of the next token and of the one before."""
        own = own_features(word)
        return float(self.own[own].sum()), float(self.near[0, own[0]]), float(self.near[1, own[0]])

    def emissions(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        e = self.bias + rows[:, 0]
        if len(e) > 1:
            inside = ~first[1:]
            e[1:] += np.where(inside, rows[:-1, 1], 0.0)
            e[:-1] += np.where(inside, rows[1:, 2], 0.0)
        return e

    def doc_score(self, features: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(features @ self.doc[1:] + self.doc[0], -30, 30)))


def doc_features(p: np.ndarray, starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Per document: largest marginal, and the log of one plus the expected number of toxic tokens."""
    out = np.zeros((len(n), 2))
    full = n > 0
    if full.any():
        at = starts[full]
        out[full, 0] = np.maximum.reduceat(p, at)
        out[full, 1] = np.log1p(np.add.reduceat(p, at))
    return out


def lexicon(docs: list[list[str]], labels: np.ndarray, least: int = 4, purity: float = 0.97) -> set[tuple[int, str]]:
    """Words (length 0) and beginnings that explain toxic documents, picked by greedy cover."""
    def forms(words: list[str]) -> set[tuple[int, str]]:
        different = set(words)
        return {(0, w) for w in different} | {(n, w[:n]) for w in different for n in PREFIXES if len(w) >= n}
    toxic, clean = [d for d, y in zip(docs, labels) if y], [d for d, y in zip(docs, labels) if not y]
    found, others = Counter(), Counter()
    for d in toxic:
        found.update(forms(d))
    often = {f for f, k in found.items() if k >= least}
    for d in clean:
        others.update(forms(d) & often)
    rate = max(1, len(clean)) / max(1, len(toxic))
    good = {f for f in often if found[f] * rate >= purity * (found[f] * rate + others[f])}
    where: dict[tuple[int, str], set[int]] = {}
    for i, d in enumerate(toxic):
        for x in forms(d) & good:
            where.setdefault(x, set()).add(i)
    # Frequent forms are toxic whether or not the cover needs them.
    chosen = {f for f in good if found[f] >= max(least, FREQUENT * len(toxic))}
    while where:
        best = max(where, key=lambda x: (len(where[x]), -x[0], x[1]))
        if len(where[best]) < least:
            break
        chosen.add(best)
        gone = where.pop(best)
        for x in list(where):
            where[x] -= gone
            if not where[x]:
                del where[x]
    return chosen


def _toxic_word(word: str, chosen: set[tuple[int, str]]) -> bool:
    return (0, word) in chosen or any((n, word[:n]) in chosen for n in PREFIXES if len(word) >= n)


def fit_tokens(docs: list[list[str]], gold: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS,
               rate: float = 0.5, penalty: float = 2e-6) -> Crf:
    """Conditional likelihood by full-batch AdaGrad; gradients are gold minus expected counts."""
    words = [w for d in docs for w in d]
    vocab = {w: i for i, w in enumerate(dict.fromkeys(words))}
    token = np.fromiter((vocab[w] for w in words), np.int64, len(words))
    table = np.array([own_features(w) for w in vocab], dtype=np.int64).reshape(-1, 1 + len(PREFIXES))
    n = np.array([len(d) for d in docs], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64)
    first = np.zeros(len(words), bool)
    first[starts[n > 0]] = True
    y = np.concatenate(gold).astype(float) if words else np.zeros(0)
    model = Crf(np.zeros(SPACE), np.zeros((2, SPACE)), -3.0, 0.0, np.zeros((2, 2)), np.zeros(3))
    seen = {k: 1e-8 for k in ("own", "near", "bias", "start", "trans")}
    inside = ~first
    size = max(1.0, float(y.sum()))
    pair_gold = np.zeros((2, 2))
    if len(y) > 1:
        np.add.at(pair_gold, (y[:-1][inside[1:]].astype(int), y[1:][inside[1:]].astype(int)), 1.0)
    for _ in range(epochs):
        rows = np.stack([model.own[table].sum(1), model.near[0, table[:, 0]], model.near[1, table[:, 0]]], 1)[token]
        r, q, e, p = marginals(model.emissions(rows, first), first, model.start, model.trans)
        miss = y - p
        by_word = np.bincount(token, miss, len(vocab))
        own = np.zeros(SPACE)
        for k in range(table.shape[1]):
            own += np.bincount(table[:, k], by_word, SPACE)
        before = np.bincount(token[:-1], np.where(inside[1:], miss[1:], 0.0), len(vocab))
        after = np.bincount(token[1:], np.where(inside[1:], miss[:-1], 0.0), len(vocab))
        near = np.stack([np.bincount(table[:, 0], before, SPACE), np.bincount(table[:, 0], after, SPACE)])
        w = np.exp(model.trans)
        x, z, g = r[:-1][inside[1:]], q[1:][inside[1:]], e[1:][inside[1:]]
        cell = np.stack([w[0, 0] + 0 * x, w[0, 1] * g * z, x * w[1, 0], x * w[1, 1] * g * z])
        expected = (cell / cell.sum(0)).sum(1).reshape(2, 2) if x.size else np.zeros((2, 2))
        grads = {"own": own / size - penalty * model.own, "near": near / size - penalty * model.near,
                 "bias": miss.sum() / size, "start": miss[first].sum() / size, "trans": (pair_gold - expected) / size}
        for name, grad in grads.items():
            seen[name] = seen[name] + grad * grad
            setattr(model, name, getattr(model, name) + rate * grad / np.sqrt(seen[name]))
    rows = np.array([model.word(w) for w in vocab]).reshape(-1, 3)[token]
    p = marginals(model.emissions(rows, first), first, model.start, model.trans)[3]
    model.doc = _logistic(doc_features(p, starts, n), labels.astype(float))
    return model


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    """Logistic regression with intercept by Newton steps."""
    x, w = np.column_stack([np.ones(len(x)), x]), np.zeros(x.shape[1] + 1)
    ridge = penalty * np.diag([1e-3] + [1.0] * (len(w) - 1))
    for _ in range(30):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(len(w)),
                                x.T @ (y - p) - ridge @ w)
    return w


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def _chosen(found: list, budget: dict[int, int]) -> list:
    """The sampled texts (toxic, hash, bytes), in a seeded order until a label's bytes are spent; at least one of each."""
    spent, chosen = Counter(), []
    for row in found:
        if spent[row["toxic"]] < budget[row["toxic"]]:
            spent[row["toxic"]] += row["bytes"]
            chosen.append(row)
    return chosen


def fit(docs: DataFrame, labels: DataFrame, sample_docs: dict[int, int] | None = None, key: str = "doc_id",
        text: str = "text", seed: int = 2, sample_bytes: dict[int, int] | None = None) -> Crf | None:
    """Learn from a seeded sample of labelled, not held-out texts; only the sample reaches the driver.

    Different texts are sampled, so one that repeats counts once, under any id.
    """
    wanted = sample_docs or SAMPLE_DOCS
    marked = labels.where("toxic is not null").groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    rows = docs.where(~held_out(key) & F.col(text).isNotNull()).select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    # Ids, lengths and hashes meet the labels; texts don't.
    sizes = rows.select("doc_id", F.octet_length("text").alias("bytes"), F.xxhash64("text").alias("hash"))
    texts = sizes.join(marked.where(F.col("toxic").isin(0, 1)), sizes["doc_id"] == marked["label_id"]) \
        .groupBy("toxic", "hash").agg(F.max("bytes").alias("bytes"))
    texts = stored(texts, "labelled-texts")
    found = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not all(found.get(k) for k in (0, 1)):
        return None
    place = unit_hash(seed, "hash")
    share = F.when(F.col("toxic") == 1, F.lit(wanted[1] / found[1])).otherwise(F.lit(wanted[0] / found[0]))
    # About SAMPLE_DOCS rows of three numbers, whatever the tables' sizes.
    chosen = _chosen(texts.where(place < share).orderBy(place, "hash").collect(), sample_bytes or SAMPLE_BYTES)
    toxic_hashes = {r["hash"] for r in chosen if r["toxic"]}
    picked = docs.sparkSession.createDataFrame([(r["hash"],) for r in chosen], "hash long").distinct()
    sample = rows.select("text", F.xxhash64("text").alias("hash")).join(F.broadcast(picked), "hash") \
        .groupBy("hash").agg(F.min("text").alias("text")).toPandas().sort_values("hash")
    y = sample["hash"].isin(toxic_hashes).to_numpy(dtype=int)
    if len(set(y)) < 2:
        return None
    words = [tokens(t) for t in sample["text"]]
    chosen = lexicon(words, y)
    toxic = {w for d in words for w in d if _toxic_word(w, chosen)}
    gold = [np.array([label and w in toxic for w in d], dtype=bool) for d, label in zip(words, y)]
    return fit_tokens(words, gold, y)


# --- scoring ----------------------------------------------------------------

class Scorer:
    def __init__(self, model: Crf):
        self.model, self.cache = model, {}
        self.rows = np.zeros((1 << 16, 3))

    def _ids(self, docs: list[list[str]]) -> np.ndarray:
        if len(self.cache) > CACHE_ENTRIES:
            self.cache = {}
        cache = self.cache
        ids = [cache.get(w, -1) for d in docs for w in d]
        if -1 in ids:
            flat = [w for d in docs for w in d]
            for k, i in enumerate(ids):
                if i < 0:
                    w = flat[k]
                    i = cache.get(w)
                    if i is None:
                        i = cache[w] = len(cache)
                        if i >= len(self.rows):
                            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
                        self.rows[i] = self.model.word(w)
                    ids[k] = i
        return np.array(ids, dtype=np.int64)

    def score(self, texts: list[str]) -> tuple[np.ndarray, list[list[dict]]]:
        """Scores and offending spans (character offsets and the largest marginal) of texts."""
        docs = [tokens(t) for t in texts]
        n = np.array([len(d) for d in docs], dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64)
        first = np.zeros(int(n.sum()), bool)
        first[starts[n > 0]] = True
        emit = self.model.emissions(self.rows_of(docs), first)
        p = marginals(emit, first, self.model.start, self.model.trans)[3]
        scores = self.model.doc_score(doc_features(p, starts, n))
        spans: list[list[dict]] = [[] for _ in texts]
        hits = np.flatnonzero(p >= SPAN_MARGINAL)
        for row in np.unique(np.searchsorted(starts + n, hits, side="right")):
            lo, hi = starts[row], starts[row] + n[row]
            spans[row] = _spans(texts[row], p[lo:hi])
        return scores, spans

    def rows_of(self, docs: list[list[str]]) -> np.ndarray:
        ids = self._ids(docs)
        return self.rows[ids]


def _spans(text: str, p: np.ndarray) -> list[dict]:
    """Runs of toxic tokens as character ranges of the text.

    Offsets are found in the lower-cased text; where lower-casing changes the
    length of a text, they refer to that lower-cased form.
    """
    out, open_span = [], False
    for m, x in zip(TOKEN.finditer(text.lower()), p):
        if x < SPAN_MARGINAL:
            open_span = False
        elif open_span:
            out[-1]["stop"], out[-1]["marginal"] = m.end(), max(out[-1]["marginal"], float(x))
        else:
            out.append({"start": m.start(), "stop": m.end(), "marginal": float(x)})
            open_span = True
    return out


SPAN_TYPE = "array<struct<start:int,stop:int,marginal:double>>"


def _score_rows(model: Crf | None):
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = per_process("scorer", name, lambda: Scorer(model)) if model else None
        spans_type = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("marginal", pa.float64())]))
        for batch in batches:
            lo = 0
            for texts in slices(batch.column(2).to_pylist()):
                scores, spans = scorer.score(texts) if scorer else (np.zeros(len(texts)), [[]] * len(texts))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(texts)), batch.column(1).slice(lo, len(texts)),
                     pa.array(scores, pa.float64()), pa.array(spans, spans_type)],
                    ["doc_id", "held_out", "score", "spans"])
                lo += len(texts)
    return run


def score_documents(docs: DataFrame, model: Crf | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, spans."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), held_out(key).alias("held_out"),
                       text_or_empty(text).alias("text"))
    scored = rows.mapInArrow(_score_rows(model), f"doc_id long, held_out boolean, score double, spans {SPAN_TYPE}")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "spans")
