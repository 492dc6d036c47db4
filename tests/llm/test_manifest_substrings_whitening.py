"""Operators 11 to 13: brute force, nulls, empty and long texts, ties, repeated rows, clashing columns, no rows."""
import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
from wattline.llm import merkle_manifest, substring_dedup, whitening

SF = "/root/testdata/sf0.001"
CLASH = ["mark", "at", "lo", "hi", "key", "leaf", "changed", "group", "block", "place", "levels", "row", "node", "witness", "root", "spans",
         "n_words", "part", "number", "size", "vec", "component", "n", "deviation", "left", "right", "c1", "single"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)


def _docs(spark, rows):
    return spark.createDataFrame([tuple(r) + ("clash",) * len(CLASH) for r in rows], SCHEMA).repartition(3)


# ---- operator 11 ----

def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _levels(nodes):
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [_h(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
        levels.append(nodes)
    return levels


def _leaf(row, more=0):
    doc, text, lang, source, n_chars = row
    values = (doc, source, lang, None if n_chars is None else n_chars + more, text)
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def _manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for x in langs:
        groups[x].sort(key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
    trees = {x: _levels([_leaf(r) for r in groups[x]]) for x in langs}
    top = _levels([trees[x][-1][0] for x in langs])
    for k, x in enumerate(langs):
        for i, r in enumerate(groups[x]):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node, proof = _leaf(r, int(tampered)), []
            for tree, at in ((trees[x], i), (top, k)):
                for level in tree[:-1]:
                    run = level[at // 2 * 2:at // 2 * 2 + 2]
                    proof += [s for j, s in enumerate(run) if j != at % 2]
                    run[at % 2] = node
                    node, at = _h(*run), at // 2
            yield r[0], _leaf(r), trees[x][-1][0], top[-1][0], tuple(proof), node, node == top[-1][0]


@pytest.mark.parametrize("height", [1, 2, 10])
def test_manifest(spark, monkeypatch, height):
    # Blocks of two and four leaves: many tiers.
    monkeypatch.setattr(merkle_manifest, "HEIGHT", height)
    rng = random.Random(height)
    rows = [(i, f"text é {i}", rng.choice([None, "en", "en", "en", "é", "-", "="]), rng.choice([None, "s"]), rng.choice([None, 5])) for i in range(70)]
    rows += [(3, None, "en", None, None), (3, "", "en", "", 0), (3, "", "en", "", 0), (None, "x", "en", "s", 1), (None, None, None, None, None),
             (99, "word " * 50_000, "alone", "s", 2 ** 63 - 2)]
    got = merkle_manifest.manifest(_docs(spark, rows)).collect()
    names = ("doc_id", "leaf", "subroot", "root", "siblings", "folded_root", "verified")
    have = sorted((tuple(tuple(r[c]) if c == "siblings" else r[c] for c in names) for r in got), key=repr)
    assert have == sorted(_manifest(rows), key=repr)
    assert 0 < sum(not r["verified"] for r in got) < len(got)


def test_manifest_of_one_and_none(spark):
    row = (1, "a", "en", "s", 1)
    got = merkle_manifest.manifest(_docs(spark, [row])).collect()
    assert [(r["leaf"], r["root"], list(r["siblings"]), r["verified"]) for r in got] == [(_leaf(row), _leaf(row), [], True)]
    assert merkle_manifest.manifest(_docs(spark, [])).count() == 0


@pytest.mark.parametrize("n", [*range(1, 20), 33])
def test_appends_close_subtrees(n):
    nodes = [_h(str(i)) for i in range(n)]
    levels = _levels(nodes)
    root, witnesses = merkle_manifest.append_all([x.encode() for x in nodes], len(levels) - 1)
    assert root.decode() == levels[-1][0]
    for node, witness in zip(nodes, witnesses):
        assert merkle_manifest.unpacked(merkle_manifest.packed(witness)) == witness
        assert merkle_manifest.folded(node.encode(), witness, len(levels) - 1) == root


# ---- operator 12 ----

def _deduped(rows, window):
    texts = [(doc, (text or "").encode().split()) for doc, text in rows]
    count = Counter(tuple(w[i:i + window]) for _, w in texts for i in range(len(w) - window + 1))
    for doc, words in texts:
        gone = {j for i in range(len(words) - window + 1) if count[tuple(words[i:i + window])] > 1 for j in range(i, i + window)}
        yield doc, len(words), len(gone), b" ".join(w for j, w in enumerate(words) if j not in gone).decode()


def _substrings(spark, rows, window):
    docs = _docs(spark, [(d, t, None, None, None) for d, t in rows])
    got = substring_dedup.dedup_substrings(docs, window=window)
    assert got.columns == ["doc_id", "n_words", "n_removed", "text"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("window,vocabulary", [(4, 3), (7, 2), (35, 2)])
def test_substrings_random(spark, window, vocabulary, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SLICE", 300)
    rng = random.Random(window)
    words = ["a", "bb", "ñandú"][:vocabulary]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 60)))) for i in range(40)]
    assert _substrings(spark, rows, window) == sorted(_deduped(rows, window), key=repr)


def test_substrings_edges(spark):
    rng = random.Random(1)

    def prose(n):
        return [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
    shared, other = prose(60), prose(35)
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, " ".join(prose(34))), (5, " ".join(prose(35))), (5, " ".join(prose(100))),
            (6, " ".join(prose(20) + shared + prose(20))), (7, " ".join(prose(3) + shared + prose(40) + shared)), (None, "  \n".join(shared)),
            (8, " ".join(other)), (8, " ".join(other)), (9, " ".join(prose(50) + other[1:] + prose(5))), (10, "same " * 200), (11, "alone " * 34),
            (12, "x y z " * 40), (13, " ".join(prose(40_000))), (14, " ".join(shared[:17] + ["cut"] + shared[17:])), (15, "\x1c\x1d a" * 50)]
    rows += [(100 + i, " ".join(shared)) for i in range(30)]
    assert _substrings(spark, rows, 35) == sorted(_deduped(rows, 35), key=repr)
    assert _substrings(spark, [], 35) == [] and _substrings(spark, [(1, "a b")], 35) == [(1, 2, 0, "a b")]
    with pytest.raises(ValueError):
        substring_dedup.repeated_windows(_docs(spark, []), window=3)


# ---- operator 13 ----

def _whitened(spark, vectors, **options):
    table = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "clash") for i, v in vectors],
                                  "vec_id long, embedding array<double>, component string").repartition(3)
    return whitening.whiten(table, **options).toPandas()


def _check(got, ids, y, k):
    n, dim = y.shape
    cov = np.cov(y.T, bias=True).reshape(dim, dim)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    assert sorted(got["vec_id"].unique()) == sorted(ids) and len(got) == n * k and (got["n"] == n).all()
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[list(ids)].to_numpy()
    want = (y - y.mean(0)) @ vectors / np.sqrt(values)
    signs = np.sign((wide * want).sum(0))
    assert np.allclose(wide, want * signs, atol=1e-7)
    exact = {i: sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, y.sum(0))) for i, row in zip(ids, y)}
    assert all(exact[i] == d for i, d in zip(got["vec_id"], got["deviation"]))
    first = got.drop_duplicates("component").sort_values("component")
    assert np.allclose(first["explained"], values / np.trace(cov), rtol=1e-9)
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-8


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((150, 6)) @ rng.standard_normal((6, 6))
    vectors = [(i, v) for i, v in enumerate(x)] + [(200, None), (201, [1, None, 0, 0, 0, 0]), (202, [np.nan] + [0] * 5), (203, [np.inf] + [0] * 5),
                                                   (204, [1.0, 2.0]), (205, [])]
    got = _whitened(spark, vectors)
    _check(got, list(range(150)), np.floor(x * 64), 6)
    _check(_whitened(spark, vectors, components=2), list(range(150)), np.floor(x * 64), 2)
    twice = _whitened(spark, [(1, v) for v in x[:3]] + [(None, v) for v in x[:3]])
    assert len(twice) == 6 * 2 and twice["vec_id"].isna().sum() == 6


def test_whitening_without_variance(spark):
    none = _whitened(spark, [])
    assert len(none) == 0 and list(none.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert len(_whitened(spark, [(1, [1, 2])])) == 0 and len(_whitened(spark, [(i, [1, 2]) for i in range(5)])) == 0
    # One direction only.
    line = _whitened(spark, [(i, [i, 2 * i, 0]) for i in range(4)])
    assert set(line["component"]) == {1} and np.allclose(line["explained"], 1) and line["identity_error"].iloc[0] < 1e-9


def test_whitening_of_equal_and_close_eigenvalues(spark):
    # Corners of a cube: one eigenvalue of multiplicity three, any orthonormal basis will do.
    cube = [(i, [i & 1, i >> 1 & 1, i >> 2 & 1, 0]) for i in range(8)]
    got = _whitened(spark, cube)
    assert set(got["component"]) == {1, 2, 3} and np.allclose(got["explained"], 1 / 3) and got["identity_error"].iloc[0] < 1e-9
    # Two eigenvalues of a scatter that differ in the 20th digit.
    big = 10 ** 20
    matrix = np.array([[big, 0, 0], [0, big + 1, 0], [0, 0, 7]], object)
    values, vectors = whitening.eigen(spark, matrix)
    assert [v >> bits for v, bits in values] == [big + 1, big, 7]
    assert np.allclose(np.abs(vectors), [[0, 1, 0], [1, 0, 0], [0, 0, 1]], atol=1e-15)


def test_large_entries_are_exact(spark):
    y = np.array([[1 << 61, -(1 << 61)], [3, 5], [-(1 << 40), (1 << 40) - 1]], np.int64)
    exact = whitening.exact_scatter(y)
    with_one = [[1, *map(int, row)] for row in y]
    assert (exact == np.array([[sum(r[i] * r[j] for r in with_one) for j in range(3)] for i in range(3)], object)).all()
    got = _whitened(spark, [(i, [x, -x]) for i, x in enumerate((1e300, 1.0, -1e300))])
    assert got["deviation"].isna().any() and np.isfinite(got["whitened"]).all()


@pytest.mark.parametrize("dim", [1, 2, 5, 9])
def test_characteristic_polynomial(spark, dim):
    rng = random.Random(dim)
    a = [[rng.randrange(-9, 10) for _ in range(dim)] for _ in range(dim + 2)]
    matrix = np.array([[sum(r[i] * r[j] for r in a) for j in range(dim)] for i in range(dim)], object)
    got = whitening.characteristic_polynomial(spark, matrix)
    # Faddeev and LeVerrier's recursion in exact integers.
    m, want = np.zeros((dim, dim), object), [1]
    for k in range(1, dim + 1):
        m = matrix.dot(m) + want[-1] * np.eye(dim, dtype=int).astype(object)
        want.append(-int(np.trace(matrix.dot(m))) // k)
    assert got == want[::-1]


# ---- queries ----

@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_substring_dedup"])
def test_query_equals_sql(spark, name):
    got = E.queries()[name](spark, SF).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(E.oracle_sql()[name]).df()
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    a, b = (x[columns].astype(str).sort_values(columns).reset_index(drop=True) for x in (got, want))
    assert a.equals(b)


def test_whitening_query(spark):
    got = E.queries()["op13_whitening"](spark, SF).toPandas()
    table = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet' ORDER BY vec_id").df()
    y = np.floor(np.stack(table["embedding"]).astype(np.float64) * 64)
    _check(got, list(table["vec_id"]), y, 32)
