"""The operators' methods on plain arrays, against enumeration or a naive form."""
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from wattline.llm import bag_minhash, language_mix, mixing, piece_lattice, sharding, toxicity


# --- mixing -------------------------------------------------------------------

@pytest.mark.parametrize("seed", range(20))
def test_subset_sum_is_best_from_below(seed):
    rng = random.Random(seed)
    lengths = np.array(rng.sample(range(1, 30), 4))
    free = np.array([rng.randint(0, 3) for _ in lengths])
    budget = rng.randint(0, 60)
    take = mixing.subset_sum(lengths, free, budget)
    assert (take <= free).all() and (take >= 0).all()
    sums = {int(np.dot(c, lengths)) for c in itertools.product(*[range(f + 1) for f in free])}
    assert int(np.dot(take, lengths)) == max(s for s in sums if s <= budget)


def test_fit_budget_hits_the_budget_and_stays_in_bounds():
    rng = np.random.default_rng(1)
    lengths = np.unique(rng.integers(1, 400, 60))
    counts = rng.integers(1, 9, len(lengths))
    total = int((lengths * counts).sum())
    for budget in (0, 1, total // 3, total // 2, total - 1, total, total + 5):
        take = mixing.fit_budget(lengths, counts, budget)
        assert (take >= 0).all() and (take <= counts).all()
        words = int((take * lengths).sum())
        assert words <= budget and (words == min(budget, total) or budget < 50 or budget == total - 1)


# --- sharding -----------------------------------------------------------------

def _jump_one(key: int, shards: int) -> int:
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_against_the_scalar_form_and_growth():
    keys = np.random.default_rng(2).integers(0, 1 << 63, 3000).astype(np.uint64)
    for n in (1, 2, 24, 25, 1000):
        assert sharding.jump_hash(keys, n).tolist() == [_jump_one(int(k), n) for k in keys]
    old, new = sharding.jump_hash(keys, 24), sharding.jump_hash(keys, 25)
    assert set(new[old != new]) <= {24}
    assert abs((old != new).mean() - 1 / 25) < 0.02


# --- toxicity -----------------------------------------------------------------

@pytest.mark.parametrize("seed", range(5))
def test_marginals_against_enumeration(seed):
    rng = np.random.default_rng(seed)
    lengths = [1, 4, 2, 7, 3]
    emit = rng.normal(size=sum(lengths)) * 2
    first = np.zeros(len(emit), bool)
    first[np.cumsum([0] + lengths[:-1])] = True
    trans, start = rng.normal(size=(2, 2)), float(rng.normal())
    p = toxicity.marginals(emit.copy(), first, start, trans)[3]
    at = 0
    for n in lengths:
        total, hits = 0.0, np.zeros(n)
        for path in itertools.product((0, 1), repeat=n):
            weight = np.exp(start * path[0] + sum(emit[at + i] * path[i] for i in range(n))
                            + sum(trans[a, b] for a, b in zip(path, path[1:])))
            total, hits = total + weight, hits + weight * np.array(path)
        assert np.allclose(p[at:at + n], hits / total)
        at += n


def test_crf_learns_spans_of_unseen_documents():
    rng = random.Random(3)
    clean = [f"word{i}" for i in range(200)]
    bad = ["vile", "nasty", "rotten"]

    def doc(toxic):
        words = [rng.choice(clean) for _ in range(30)]
        if toxic:
            words[rng.randrange(30)] = rng.choice(bad)
        return words
    labels = np.array([i % 2 for i in range(200)])
    docs = [doc(y) for y in labels]
    chosen = toxicity.lexicon(docs, labels)
    toxic = {w for d in docs for w in d if toxicity._toxic_word(w, chosen)}
    assert toxic == set(bad)
    gold = [np.array([y and w in toxic for w in d], dtype=bool) for d, y in zip(docs, labels)]
    model = toxicity.fit_tokens(docs, gold, labels)
    scorer = toxicity.Scorer(model)
    texts = ["word1 word2 Vile word3", "word1 word2 word3", ""]
    scores, spans = scorer.score(texts)
    assert scores[0] >= 0.7 and scores[1] < 0.3 and scores[2] < 0.3
    assert [texts[0][s["start"]:s["stop"]] for s in spans[0]] == ["Vile"] and spans[1] == [] and spans[2] == []


# --- language mixture ---------------------------------------------------------

def test_mixture_proportions_and_selection():
    rng = np.random.default_rng(4)
    def units(parts):
        rows = []
        for lang, n in enumerate(parts):
            x = rng.normal(-20, 1, (n, 3))
            x[:, lang] += 12
            rows.append(x)
        return np.concatenate(rows)
    docs = [units((30, 10, 0)), units((0, 0, 5)), units((1, 0, 0))]
    share, full = language_mix.infer(np.concatenate(docs), np.array([40, 5, 1]))
    assert np.allclose(share[0], [0.75, 0.25, 0], atol=0.02)
    assert np.allclose(share[1], [0, 0, 1]) and np.allclose(share[2], [1, 0, 0])
    assert np.allclose(full.sum(1), 1)


# --- BagMinHash ---------------------------------------------------------------

@pytest.mark.parametrize("a,b", [((1, 2, 3, 7, 0, 40), (1, 3, 2, 9, 4, 33)), ((5, 3), (3, 6)), ((1,) * 50, (1,) * 40 + (0,) * 10)])
def test_signatures_agree_as_often_as_weighted_jaccard(a, b):
    rng = np.random.default_rng(5)
    found = []
    for _ in range(150):
        shingles = rng.integers(0, 2 ** 63, len(a)).astype(np.uint64)
        rows = [(0, s, w) for s, w in zip(shingles, a) if w] + [(1, s, w) for s, w in zip(shingles, b) if w]
        doc, s, w = (np.array(x) for x in zip(*rows))
        names = bag_minhash.sign(doc, s.astype(np.uint64), w, 2)
        found.append((names[0] == names[1]).mean())
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs(np.mean(found) - true) < 5 * np.std(found) / np.sqrt(len(found)) + 1e-9


def test_shingles_short_and_long_texts():
    words = np.arange(1, 12).astype(np.uint64)
    shingles, count = bag_minhash.shingle_hashes(words, np.array([0, 3, 6, 2]))
    assert count.tolist() == [0, 1, 2, 1] and len(set(shingles.tolist())) == 4
    again, _ = bag_minhash.shingle_hashes(words[3:9], np.array([6]))
    assert again.tolist() == shingles[1:3].tolist()
    sets = bag_minhash.elements(np.array([7, 7, 9, 7], dtype=np.uint64), np.array([3, 1]))
    assert len(set(sets[0].tolist())) == 3 and len(set(sets[0].tolist()) & set(sets[1].tolist())) == 1


# --- SentencePiece ------------------------------------------------------------

def test_units_are_cut_where_no_piece_spans():
    model = piece_lattice.piece_model([("<unk>", 0.0, 2), ("▁", -1.0, 1), ("ab", -2.0, 1), ("bab", -3.0, 1)], piece_lattice.BPE)
    unit = "abab" * 40 + "aa" + "b" * 70
    parts = model.parts(unit)
    assert "".join(parts) == unit and parts[0] == "abab" * 40 + "a" and parts[1] == "ab" and parts[2:] == ["b"] * 69
    assert all(p[i:i + 2] in model.together for p in parts for i in range(len(p) - 1))


def test_mask_ends():
    assert piece_lattice.mask_ends([0b1011], 3) == [1, 3]
    assert piece_lattice.mask_ends([1 | 1 << 60], 60) == [60]
    assert piece_lattice.mask_ends([1 | 1 << 59, 1 | 1 << 7], 67) == [59, 60, 67]
    assert piece_lattice.mask_ends([1, 0, 1], 120) == [120]
