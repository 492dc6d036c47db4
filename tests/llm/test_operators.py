"""Every operator on rows with nulls, empty and long texts, ties, repeats, clashing columns, and on no rows."""
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wattline.llm import (bag_minhash, exact_dedup, language_mix, line_windows, mixing, nn_descent, piece_lattice,
                          sharding, token_files, toxicity)
from wattline.llm.common import apply_decisions, row_mark
from wattline.llm.components import connected_components

#: Columns that share a name with something an operator makes on its way.
CLASH = ["size", "row", "node", "mark", "bag", "name", "block", "shard", "u", "bucket", "component", "ids", "rank",
         "hash", "lines", "words", "units", "taken", "__mark", "__lang", "lang_pred", "repeats", "start", "part"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)
LONG = " ".join(f"w{i % 997} x{i}" for i in range(20_000))
TEXTS = [None, "", " \n\t", "A b", "a B", "a b", "one two three four five six seven", "l1\nl2\nl3\nl4", "l0\nl1\nl2\nl3\nzz",
         LONG, LONG, "naïve 中文 <|endoftext|> œuvre\n", "123 456", "one two three four five six seven"]
IDS = [1, 2, 3, 4, 5, None, 7, 8, 9, 10, 11, 12, 13, 7]


def _rows():
    for i, (doc, text) in enumerate(zip(IDS, TEXTS)):
        yield (doc, text, [None, "en", "fr"][i % 3], [None, "s1", "s2", "s10"][i % 4], None if i % 2 else i) + ("clash",) * len(CLASH)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(_rows()), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_marks_and_decisions(docs):
    marks = docs.select(row_mark("doc_id", "text").alias("m"))
    assert marks.distinct().count() == len(set(zip(IDS, TEXTS)))
    kept = apply_decisions(docs, docs.select(row_mark("doc_id", "text").alias("mark"), F.when(F.col("doc_id") == 8, 2).otherwise(1).alias("repeats")))
    assert kept.columns == docs.columns
    got = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    # The row that is there twice has both rows' repeats.
    assert got == Counter(dict.fromkeys(zip(IDS, TEXTS), 1)) + Counter({(8, TEXTS[7]): 1, (7, TEXTS[6]): 1})
    assert apply_decisions(docs.limit(0), docs.select(row_mark("doc_id", "text").alias("mark"), F.lit(1).alias("repeats"))).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i + 100, i + 101) for i in range(40)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        lo, hi = sorted((root(a), root(b)))
        parent[hi] = lo
    found = connected_components(spark.createDataFrame(edges + [(None, 5)], "a long, b long"))
    assert {r["node"]: r["component"] for r in found.collect()} == {x: root(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_exact_dedup(docs, none):
    rows = exact_dedup.exact_dedup(docs, block=3).collect()
    groups = defaultdict(list)
    for doc, text in zip(IDS, TEXTS):
        norm = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        groups[hashlib.sha256(norm.encode()).hexdigest()].append(doc)
    assert len(rows) == len(IDS)
    for r in rows:
        ids = groups[r["text_sha256"]]
        assert r["group_size"] == len(ids) and r["keep_id"] == max((i for i in ids if i is not None), default=None)
    assert Counter(r["text_sha256"] for r in rows if r["kept"]) == Counter(groups.keys())
    assert all(r["doc_id"] == r["keep_id"] for r in rows if r["kept"])
    assert exact_dedup.exact_dedup(none).count() == 0


def test_block_names_of_random_texts(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(0, 14))) for _ in range(300)] + ["ab" * 5] * 150
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows = exact_dedup.exact_dedup(docs, block=2).collect()
    last = {t: i for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["keep_id"] for r in rows} == {i: last[t] for i, t in enumerate(texts)}


def _lines_kept(rows):
    """Brute force: rows as (doc_id, text) in order; what is left of each text."""
    seen, out = set(), []
    for _, text in rows:
        lines = text.split("\n")
        gone = set()
        for i in range(len(lines) - 2):
            w = tuple(lines[i:i + 3])
            if w in seen:
                gone |= {i, i + 1, i + 2}
            seen.add(w)
        out.append("\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text)
    return out


def test_line_windows(docs, none, spark):
    rows = line_windows.dedup_lines(docs).collect()
    assert len(rows) == len(IDS)
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    assert by[1][0]["text"] is None and by[1][0]["n_lines"] == 0 and by[2][0]["text"] == ""
    assert by[8][0]["text"] == TEXTS[7] and by[9][0]["text"] == "l0\nzz" and by[9][0]["n_removed"] == 3
    assert [tuple(x) for x in by[9][0]["removed"]] == [(1, 3)]
    rng = random.Random(8)
    texts = ["\n".join(rng.choice("abc") for _ in range(rng.randrange(0, 9))) for _ in range(80)]
    some = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["text"] for r in line_windows.dedup_lines(some).collect()}
    assert [got[i] for i in range(80)] == _lines_kept(list(enumerate(texts)))
    same = spark.createDataFrame([(5, "x\ny\nz"), (5, "x\ny\nz"), (6, "x\ny"), (6, "x\ny")], "doc_id long, text string")
    assert sorted(r["text"] for r in line_windows.dedup_lines(same).collect()) == ["", "x\ny", "x\ny", "x\ny\nz"]
    assert line_windows.dedup_lines(none).count() == 0


def test_sharding(docs, none):
    rows = sharding.shard_documents(docs, 4).collect()
    assert len(rows) == len(IDS)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 4)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in zip(IDS, TEXTS))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    assert sharding.shard_documents(none, 4).count() == 0


def test_sharding_ranks_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 7)
    docs = spark.range(900).select((F.col("id") % 600).alias("doc_id"), F.col("id").cast("string").alias("text"))
    rows = sharding.shard_documents(docs, 3).collect()
    for shard in range(3):
        own = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert own == list(range(len(own)))


def test_mixing(docs, none, spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 6)
    rng = random.Random(9)
    some = spark.createDataFrame([(i, " ".join("w" * 1 for _ in range(rng.choice([0, 3, 3, 3, 8, 21]))),
                                   rng.choice([None, "a", "b", "c", "é", "Z"])) for i in range(700)],
                                 "doc_id long, text string, source string").repartition(4)
    for table in (docs, some):
        rows = mixing.mix(table).collect()
        source = sorted({r["source"] for r in rows}, key=lambda s: (s is None, s or ""))
        size = {s: sum(r["size"] for r in rows if r["source"] == s) for s in source}
        weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(source)}
        target, free, budget = {}, set(source), 1.5 * sum(size.values())
        while True:
            part = {s: budget * weight[s] / sum(weight[x] for x in free) for s in free}
            over = {s for s in free if part[s] > 2 * size[s]}
            if not over:
                target |= part
                break
            for s in over:
                target[s] = 2 * size[s]
                budget -= target[s]
            free -= over
        for s in source:
            own = [r for r in rows if r["source"] == s]
            assert all(abs(r["target"] - target[s]) < 1e-6 and r["source_size"] == size[s] for r in own)
            assert all(0 <= r["taken"] <= 2 * r["size"] for r in own)
        if table is some:
            assert all(abs(sum(r["taken"] for r in rows if r["source"] == s) - target[s]) <= 3 for s in source)
        again = mixing.mix(table.repartition(2)).collect()
        key = lambda r: (str(r["doc_id"]), r["size"], r["taken"])
        assert sorted(map(key, rows)) == sorted(map(key, again))
    assert mixing.mix(none).count() == 0


def test_token_files(docs, none, spark, scratch):
    import pyarrow.dataset as ds
    import pyarrow.parquet as pq
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = token_files.token_output(docs, path, 0, f"{scratch}/tokens").orderBy("start").collect()
    ids = {(d, t): library.encode(t or "", add_special_tokens=False).ids + [0] for d, t in zip(IDS, TEXTS)}
    want = Counter((d, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (d, t), x in ids.items())
    want[(7, len(ids[7, TEXTS[6]]), zlib.crc32(np.array(ids[7, TEXTS[6]], "<u4").tobytes()))] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == want
    before, order = 0, []
    for r in rows:
        assert r["start"] == before
        before += r["n_tokens"]
        order.append(-1 if r["doc_id"] is None else r["doc_id"])
    assert order == sorted(order)
    file = ds.dataset(f"{scratch}/tokens", format="parquet").files[-1]
    meta = pq.ParquetFile(file).metadata.row_group(0)
    columns = {meta.column(i).path_in_schema: meta.column(i) for i in range(meta.num_columns)}
    assert "RLE_DICTIONARY" in columns["ids.list.element"].encodings
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings and columns["doc_id"].has_column_index
    one = token_files.read_token_files(spark, f"{scratch}/tokens").where("doc_id = 4").collect()
    assert one[0]["ids"] == ids[4, "A b"]
    assert token_files.token_output(none, path).count() == 0


def test_cached_encoder_equals_the_library(monkeypatch):
    monkeypatch.setattr(token_files, "CACHE_ENTRIES", 20)
    encoder = token_files.TextEncoder(public_tokenizers.path("byte_bpe_50k.json"), 0)
    rng = random.Random(10)
    alphabet = "aB'stre 0²é\n\t  .,-—中\x1c\x85 ʰ×"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(400)] + ["it's I'LL 'tis", LONG[:2000]]
    for lo in range(0, len(texts), 50):
        lengths, ids = encoder.encode(texts[lo:lo + 50])
        want = encoder.tokenizer.encode_batch(texts[lo:lo + 50], add_special_tokens=False)
        assert [g.tolist() for g in np.split(ids, np.cumsum(lengths)[:-1])] == [w.ids + [0] for w in want]


def test_toxicity(docs, none, spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 14)] + [(2, None), (None, 1)], "doc_id long, toxic int")
    rows = toxicity.score_documents(docs, toxicity.fit(docs, labels)).collect()
    assert len(rows) == len(IDS) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert toxicity.fit(docs, labels.limit(0)) is None
    assert {r["score"] for r in toxicity.score_documents(docs, None).collect()} == {0.0}
    assert toxicity.score_documents(none, toxicity.fit(none, labels)).count() == 0


def _invented(rng, letters, n):
    """Words of a language of its own: syllables from some letters."""
    return [" ".join("".join(rng.choice(letters) + rng.choice("aeiou") for _ in range(rng.randrange(1, 4))) for _ in range(60)) for _ in range(n)]


def test_unlearned_language_is_rejected(spark):
    rng = random.Random(3)
    learned = {"xx": _invented(rng, "bdgklm", 60), "yy": _invented(rng, "nprstv", 60)}
    foreign = _invented(rng, "chjqwz", 20) + [" ".join("".join(rng.choice("абвгдежз") for _ in range(5)) for _ in range(50))]
    mixed = [" ".join(a.split()[:30] + b.split()[:30]) for a, b in zip(learned["xx"], learned["yy"])][:10]
    rows = [(i, t, x) for x, texts in learned.items() for i, t in enumerate(texts, 1000 * len(x) * (x == "yy"))]
    rows += [(9000 + i, t, None) for i, t in enumerate(foreign)] + [(9500 + i, t, None) for i, t in enumerate(mixed)] + [(9900, "qwz", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    kept = {r["doc_id"] for r in language_mix.keep_identified(docs, language_mix.fit(docs)).collect()}
    # All labelled documents, held-out ones too, texts in two languages and ones too short to tell; none of the others.
    assert kept == {i for i, _, _ in rows if not 9000 <= i < 9500}


def test_pipeline_learns_from_all_labelled_documents(spark, monkeypatch):
    """Models and floors of the pipeline's first stage don't come from a sample: they are there when a sample would be empty."""
    monkeypatch.setattr(language_mix, "unit_hash", lambda seed, *cols: F.lit(2.0))
    rng = random.Random(5)
    rows = [(1000 * k + i, t, lang) for k, (lang, letters) in enumerate([("xx", "bdgklm"), ("yy", "nprstv")])
            for i, t in enumerate(_invented(rng, letters, 40))]
    rows += [(9000 + i, t, None) for i, t in enumerate(_invented(rng, "chjqwz", 10))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    kept = {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs, "").collect()}
    assert kept == {i for i, _, lang in rows if lang}
    model = language_mix.fit(docs, sample_docs=None)
    grams = Counter(g for i, t, lang in rows if lang == "xx" and zlib.crc32(str(i).encode()) % 5 for w in language_mix.words(t)
                    for g in language_mix.trigrams(w))
    assert {g for g, n in grams.items()} <= set(model.grams) and len(model.languages) == 2
    total = sum(grams.values()) + language_mix.SMOOTHING * len(model.table)
    assert all(abs(model.table[model.grams[g], 0] - np.log((n + language_mix.SMOOTHING) / total)) < 1e-9 for g, n in grams.items())


def test_toxic_documents_that_are_all_long(spark):
    rng = random.Random(4)
    bad = ["vile", "scum", "filth"]

    def prose(n, toxic):
        return " ".join(rng.choice(bad) if toxic and rng.random() < 0.05 else f"w{rng.randrange(300)}" for _ in range(n))
    rows = [(i, prose(6000 if i % 2 else rng.choice([50, 6000]), i % 2 == 1), i % 2) for i in range(90)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    assert min(len(r[1]) for r in rows if r[2]) > 20_000
    score = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, toxicity.fit(docs, labels)).collect()}
    assert min(score[r[0]] for r in rows if r[2]) > 0.7 > 0.3 > max(score[r[0]] for r in rows if not r[2])
    # A budget of a few bytes still takes one text of each label.
    assert toxicity.fit(docs, labels, sample_bytes={0: 1, 1: 1}) is not None


def test_words_with_a_common_beginning_differ():
    long = "a" * 24
    assert toxicity.own_features(long + "xyz")[0] != toxicity.own_features(long + "abc")[0]


def test_language_mix(docs, none):
    model = language_mix.fit(docs)
    rows = language_mix.identify(docs, model).collect()
    assert len(rows) == len(IDS) and all(0 <= r["score"] <= 1 for r in rows)
    by = {r["doc_id"]: r for r in rows}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (1, 2, 3, 13))
    assert by[10]["lang_pred"] in model.languages
    kept = language_mix.keep_identified(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(IDS) - 4
    assert {r["doc_id"] for r in kept.collect()} == set(IDS) - {1, 2, 3, 13}
    assert language_mix.identify(none, language_mix.fit(none)).count() == 0
    assert {r["lang_pred"] for r in language_mix.identify(docs, language_mix.fit(none)).collect()} == {"und"}


def test_near_duplicates_of_small_texts(docs, none, spark):
    rows = bag_minhash.near_dedup(docs).collect()
    assert len(rows) == len(IDS)
    by = defaultdict(set)
    for r in rows:
        by[r["doc_id"]].add((r["class_id"], r["class_size"]))
    assert by[1] == by[2] == by[3] == {(1, 3)}            # null, empty and blank
    assert by[4] == by[5] == by[None] == {(4, 3)}         # one shingle of two words, whatever the case
    assert by[7] == {(7, 2)} and by[10] == by[11] == {(10, 2)}
    assert Counter(r["class_id"] for r in rows if r["kept"]) == Counter({r["class_id"] for r in rows})
    assert bag_minhash.near_dedup(none).count() == 0


def _bag(text):
    words = (text or "").lower().split()
    return Counter(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter({(): 1})


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(11)
    base = [[rng.choice("abcdefghijklmnop") + str(rng.randrange(40)) for _ in range(rng.randrange(3, 90))] for _ in range(12)]
    common = [f"common{i}" for i in range(40)]
    texts = []
    for words in base:
        for _ in range(12):
            w = list(words)
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
            texts.append(" ".join(w))
    texts += [" ".join(common + [f"own{i}x{j}" for j in range(rng.randrange(5, 40))]) for i in range(60)]
    bags, parent = [_bag(t) for t in texts], list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(texts)):
        for j in range(i):
            if sum((bags[i] & bags[j]).values()) >= 0.8 * sum((bags[i] | bags[j]).values()):
                lo, hi = sorted((root(i), root(j)))
                parent[hi] = lo
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    got = {r["doc_id"]: r["class_id"] for r in bag_minhash.near_dedup(docs).collect()}
    assert got == {i: root(i) for i in range(len(texts))}


def _vectors(spark):
    rng = np.random.default_rng(12)
    x = rng.standard_normal((220, 16))
    for c in range(6):
        x[c * 20:(c + 1) * 20] = x[c * 20] + 0.12 * rng.standard_normal((20, 16))
    x[:15] = x[0]
    rows = [(i, [float(v) for v in x[i]]) for i in range(220)]
    rows += [(300, None), (301, []), (302, [0.0] * 16), (303, [float("nan")] + [1.0] * 15), (304, [None] + [1.0] * 15),
             (305, [float("inf")] + [1.0] * 15), (306, [1.0, 2.0]), (None, rows[0][1]), (5, rows[0][1])]
    return rows


def test_nn_descent_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "BLOCK", 8)
    rows = _vectors(spark)
    frame = spark.createDataFrame([r + ("x",) for r in rows], "vec_id long, embedding array<double>, node string").repartition(4)
    found, recall = nn_descent.near_duplicates(frame)
    good = [i for i, (_, v) in enumerate(rows) if i < 220 or i >= 227]
    x = nn_descent.unit(np.array([rows[i][1] for i in good]))
    link = (x @ x.T >= 0.95) & ~np.eye(len(good), dtype=bool)
    comp = list(range(len(good)))
    for _ in range(len(good)):
        new = [min([comp[i]] + [comp[j] for j in np.flatnonzero(link[i])]) for i in range(len(good))]
        if new == comp:
            break
        comp = new
    name = {c: min(rows[good[i]][0] for i in range(len(good)) if comp[i] == c and rows[good[i]][0] is not None) for c in set(comp)}
    want = Counter((rows[g][0], int(link[i].sum()), name[comp[i]], rows[g][0] == name[comp[i]]) for i, g in enumerate(good))
    want += Counter((i, 0, i, True) for i in range(300, 307))
    assert Counter((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in found.collect()) == want
    assert recall >= 0.9
    empty, _ = nn_descent.near_duplicates(frame.limit(0))
    assert empty.count() == 0


@pytest.mark.parametrize("hot", [1 << 19, 3])
def test_piece_lattice(docs, none, monkeypatch, hot):
    import sentencepiece
    monkeypatch.setattr(piece_lattice, "HOT_UNITS", hot)
    monkeypatch.setattr(piece_lattice, "SAMPLE_DOCS", 9)
    path = public_tokenizers.path("piece_bpe_32k.model")
    model, library = piece_lattice.load_model(path), sentencepiece.SentencePieceProcessor(model_file=path)
    coded = piece_lattice.encode(docs, model)
    rows = coded.collect()
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in rows) == Counter(
        (d, tuple(library.encode(t or ""))) for d, t in zip(IDS, TEXTS))
    decoded = piece_lattice.decode(coded, model).collect()
    assert Counter((r["doc_id"], r["text"]) for r in decoded) == Counter((d, t or "") for d, t in zip(IDS, TEXTS))
    assert all(r["decoded"] for r in piece_lattice.digest(coded, model).collect())
    assert piece_lattice.digest(piece_lattice.encode(none, model), model).count() == 0


def test_units_of_any_length_equal_the_library(spark):
    import sentencepiece
    rng = random.Random(5)
    path = public_tokenizers.path("piece_bpe_32k.model")
    model, library = piece_lattice.load_model(path), sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["a" * 200, "representation" * 9, "the  quick▁ 中文 fox\n\tnaïve", "ab" * 70 + "!" * 80, " " * 300 + "x", "",
             "".join(chr(rng.randrange(0x4e00, 0x9fa5)) for _ in range(3_000)), "的中国人民大学是我们" * 40,
             "".join(chr(rng.randrange(0xe01, 0xe3a)) for _ in range(2_000)),
             "".join(rng.choice("etaoinshrdlu") for _ in range(10_000)), "=" * 1_000 + "-" * 61 + "x" * 60 + "y" * 61] \
        + ["".join(rng.choice("etaoinsh") for _ in range(n)) for n in range(55, 70)] \
        + ["▁".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(50, 130))) for _ in range(3)) for _ in range(9)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: list(r["ids"]) for r in piece_lattice.encode(frame, model).collect()}
    assert got == {i: library.encode(t) for i, t in enumerate(texts)}


def test_viterbi_on_units_of_any_length(spark):
    rng = random.Random(3)
    pieces = ["▁", "a", "b", "c"] + sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(2, 6))) for _ in range(60)})
    score = {p: -rng.random() * len(p) - 0.5 for p in dict.fromkeys(pieces)}
    model = piece_lattice.piece_model([("<unk>", 0.0, 2)] + [(p, score[p], 1) for p in score], piece_lattice.UNIGRAM)
    units = ["▁" + "".join(rng.choice("abcz" if n % 2 else "abc") for _ in range(n)) for n in (59, 60, 61, 119, 121, 400)]
    unknown = min(score.values()) - 10
    got = {r["unit"]: r["ids"] for r in piece_lattice.encode_units(spark.createDataFrame([(u, k) for u in units for k in (1, 2)], "unit string, mark long"), model).collect()}
    assert set(got) == set(units)
    for u in units:
        best = [0.0] + [-1e18] * len(u)
        for i in range(1, len(u) + 1):
            best[i] = max(best[j] + score.get(u[j:i], unknown if i - j == 1 else -1e9) for j in range(max(0, i - 6), i))
        total = sum(score[model.pieces[i]] if i else unknown for i in np.frombuffer(got[u], "<u2"))
        assert abs(total - best[-1]) < 1e-6


def test_viterbi_on_a_unigram_table(spark):
    rng = random.Random(13)
    pieces = ["▁", "a", "b", "c"] + sorted({"".join(rng.choice("abc▁") for _ in range(rng.randrange(2, 5))) for _ in range(40)})
    pieces = [p for p in dict.fromkeys(pieces) if "▁" not in p[1:]]
    score = {p: -rng.random() * len(p) - 0.5 for p in pieces}
    model = piece_lattice.piece_model([("<unk>", 0.0, 2)] + [(p, score[p], 1) for p in pieces], piece_lattice.UNIGRAM)
    units = sorted({"▁" + "".join(rng.choice("abcz") for _ in range(rng.randrange(1, 8))) for _ in range(40)})
    frame = spark.createDataFrame([(u, 7) for u in units], "unit string, mark long")
    unknown = min(score.values()) - 10

    def best(u):
        if not u:
            return 0.0
        return max((best(u[k:]) + (score.get(u[:k], unknown if k == 1 else -1e9)) for k in range(1, len(u) + 1)))
    for r in piece_lattice.encode_units(frame, model).collect():
        ids = np.frombuffer(r["ids"], "<u2")
        got = sum(score[model.pieces[i]] if i else unknown for i in ids)
        assert abs(got - best(r["unit"])) < 1e-9


def test_pipeline_stages_keep_columns_and_handle_edges(spark, docs, none):
    for table, least in ((docs, 1), (none, 0)):
        rows = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            before = rows
            rows = stage(spark, before, "")
            assert rows.columns == table.columns, name
            assert rows.dtypes == table.dtypes
            rows = spark.createDataFrame(rows.collect(), table.schema)
        final = corpus_pipeline.STAGES[-1][1](spark, rows, "").collect()
        assert len(final) == rows.count() >= least and all(r["decoded"] for r in final)
