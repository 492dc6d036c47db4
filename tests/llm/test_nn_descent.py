"""NN-descent where the audit's sample can't supply the links: several thousand different vectors, against all pairs."""
from collections import Counter

import numpy as np
import pytest

from wattline.llm import nn_descent

DIM = 64


def _noise(rng, n):
    x = rng.standard_normal((n, DIM))
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _at(rng, x, cosine):
    """Unit vectors at about ``cosine`` to the unit vectors ``x``."""
    return nn_descent.unit(cosine * x + np.sqrt(1 - cosine ** 2) * _noise(rng, len(x)))


def _clumps(rng, groups, members=12):
    """Two tight clumps a group, at cosine 0.97 to each other."""
    centre = _noise(rng, groups)
    both = np.concatenate([centre, _at(rng, centre, 0.975)])
    return _at(rng, np.repeat(both, members, axis=0), 0.9985)


def _want(x):
    link = (x @ x.T >= nn_descent.THRESHOLD) & ~np.eye(len(x), dtype=bool)
    comp = np.arange(len(x))
    while True:
        new = np.minimum(comp, np.where(link, comp[None, :], len(x)).min(1))
        if (new == comp).all():
            return link.sum(1), comp
        comp = new


def _check(spark, x):
    x = x[np.random.default_rng(1).permutation(len(x))]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(8)
    rows = nn_descent.near_duplicates(frame)[0].collect()
    links, comp = _want(x)
    assert links.any()
    assert len({r["component_id"] for r in rows}) == len(set(comp))
    assert Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in rows) == Counter(zip(range(len(x)), links, comp))


def test_clumps_with_full_lists_are_joined(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "AUDITED", 0)
    _check(spark, _clumps(np.random.default_rng(3), 100))


def _isolated(rng, pairs):
    """Pairs just above 0.95, each far from all others."""
    x = _noise(rng, pairs)
    side = _noise(rng, pairs)
    side -= (side * x).sum(1, keepdims=True) * x
    return np.concatenate([x, 0.951 * x + np.sqrt(1 - 0.951 ** 2) * nn_descent.unit(side)])


def test_isolated_pairs_are_found_without_the_audit(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "AUDITED", 0)
    _check(spark, _isolated(np.random.default_rng(4), 1_500))


def test_orders_grow_with_the_rows():
    few, many, most = (nn_descent.orders_needed(n, 0.95) for n in (2, 10_000, 10_000_000))
    assert few < many < most < 100


def test_recall_below_the_target_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "_relabelled", lambda vecs, links: (vecs, False))
    monkeypatch.setattr(nn_descent, "EXTRA_ORDERS", 0)
    x = _isolated(np.random.default_rng(6), 50)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    with pytest.raises(RuntimeError, match="recall of audited links is 0.0000"):
        nn_descent.near_duplicates(frame)


def test_recall_counts_nodes_besides_links(spark):
    nodes = spark.createDataFrame([(i, 0 if i < 10 else i) for i in range(12)], "node long, component long")
    pairs = [(0, i, 1.0) for i in range(1, 10)] + [(10, 11, 1.0)]
    assert nn_descent._recall(spark.createDataFrame(pairs, nn_descent.PAIR), nodes) == 0.5


def test_clumps_pairs_and_a_hot_group_with_few_audited_nodes(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "AUDITED", 5)
    rng = np.random.default_rng(5)
    hot = _at(rng, np.repeat(_noise(rng, 1), 600, axis=0), 0.99)
    _check(spark, np.concatenate([_clumps(rng, 50), _isolated(rng, 500), hot]))
