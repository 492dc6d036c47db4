"""The registered queries of this subpackage and their DuckDB SQL."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import bag_minhash, exact_dedup, language_mix, line_windows, merkle_manifest, mixing, nn_descent, piece_lattice, \
    sharding, substring_dedup, token_files, toxicity, whitening


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents")).drop("repeats", "mark")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _read(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs, model)
    return scored.withColumn("spans", F.transform("spans", lambda s: F.array(s["start"], s["stop"])))


def op3_language_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return language_mix.identify(docs, language_mix.fit(docs))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_output(_read(spark, sf_dir, "documents"),
                                    public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


def op5_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(_read(spark, sf_dir, "embeddings"))[0]


def op6_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_windows.dedup_lines(_read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_removed", F.size("removed").alias("n_ranges"),
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"), "text")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_read(spark, sf_dir, "documents")).drop("mark")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_read(spark, sf_dir, "documents"), n_shards=24)


def op9_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = piece_lattice.load_model(public_tokenizers.path("piece_bpe_32k.model"))
    return piece_lattice.encode_and_check(_read(spark, sf_dir, "documents"), model)


def op10_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_minhash.near_dedup(_read(spark, sf_dir, "documents")).drop("mark")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merkle_manifest.manifest(_read(spark, sf_dir, "documents"))
    return rows.withColumn("proof_sha256", F.sha2(F.array_join("siblings", ""), 256)).drop("siblings")


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring_dedup.dedup_substrings(_read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_read(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_mixing, op2_toxicity, op3_language_mix, op4_token_files, op5_nn_descent, op6_line_windows, op7_exact_dedup, op8_sharding, op9_piece_lattice,
                                 op10_bag_minhash, op11_merkle_manifest, op12_substring_dedup, op13_whitening)}

ORACLE_SQL = {
    "op6_line_windows": """
        WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
        w AS (SELECT doc_id, p, ls[p] || chr(10) || ls[p + 1] || chr(10) || ls[p + 2] AS w
              FROM d, unnest(range(1, len(ls) - 1)) AS t(p)),
        later AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (
                    PARTITION BY md5(w) ORDER BY doc_id, p) AS r FROM w) WHERE r > 1),
        gone AS (SELECT doc_id, list_sort(list_distinct(flatten(list([p, p + 1, p + 2])))) AS g FROM later GROUP BY doc_id),
        r AS (SELECT d.doc_id, d.text, len(ls) AS n_lines, coalesce(g, []) AS g,
                     CASE WHEN g IS NULL THEN d.text ELSE array_to_string(
                       [ls[i] FOR i IN range(1, len(ls) + 1) IF NOT list_contains(g, i)], chr(10)) END AS clean
              FROM d LEFT JOIN gone USING (doc_id))
        SELECT doc_id, n_lines, len(g) AS n_removed,
               len([i FOR i IN g IF NOT list_contains(g, i - 1)]) AS n_ranges,
               sha256(clean) AS text_sha256, clean AS text FROM r""",
    "op7_exact_dedup": """
        WITH d AS (
          SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                   'abcdefghijklmnopqrstuvwxyz') AS t
          FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
               sha256(t) AS text_sha256
        FROM d""",
    # crc32 bit by bit: DuckDB has no such function. Level by level, every two neighbours of a group are hashed; a
    # group's level count is that of halving its size until one is left.
    "op11_merkle_manifest": """
        WITH RECURSIVE
        crc AS (SELECT doc_id, list_reduce(list_concat([4294967295::UBIGINT],
                  [ascii(c)::UBIGINT FOR c IN string_split(doc_id::VARCHAR, '')]),
                  lambda s, b: list_reduce(list_concat([xor(s, b)], [0::UBIGINT FOR i IN range(8)]),
                    lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::UBIGINT ELSE 0 END))) AS c
                FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
        d AS (SELECT doc_id, lang, concat(
                coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-'),
                coalesce(octet_length(encode(source)) || ':' || source, '-'),
                coalesce(octet_length(encode(lang)) || ':' || lang, '-')) AS head,
                coalesce(octet_length(encode(text)) || ':' || text, '-') AS tail, n_chars,
                coalesce(xor(c, 4294967295) % 7 = 0, false) AS audited
              FROM documents LEFT JOIN crc USING (doc_id)),
        l AS (SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
                CASE WHEN audited THEN sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) END AS changed
              FROM d),
        p AS (SELECT *, coalesce('=' || lang, '-') AS grp,
                row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l),
        up(grp, lvl, pos, h, n) AS (
          SELECT grp, 0, pos, leaf, count(*) OVER (PARTITION BY grp) FROM p
          UNION ALL
          SELECT grp, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2
          FROM up WHERE n > 1 GROUP BY grp, lvl, pos // 2),
        sub AS (SELECT grp, h, row_number() OVER (ORDER BY encode(grp)) - 1 AS pos FROM up WHERE n = 1),
        top(lvl, pos, h, n) AS (
          SELECT 0, pos, h, count(*) OVER () FROM sub
          UNION ALL
          SELECT lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2
          FROM top WHERE n > 1 GROUP BY lvl, pos // 2),
        tree AS (
          SELECT grp, lvl, pos, h, n FROM up
          UNION ALL
          SELECT sub.grp, lvls + top.lvl, top.pos, top.h, top.n
          FROM top, sub JOIN (SELECT grp, max(lvl) AS lvls FROM up GROUP BY grp) USING (grp) WHERE top.lvl > 0 OR top.n > 1),
        walk(id, grp, lvl, pos, h, proof) AS (
          SELECT row_number() OVER (), grp, 0, pos, coalesce(changed, leaf), '' FROM p
          UNION ALL
          SELECT id, w.grp, w.lvl + 1, w.at // 2,
                 sha256(CASE WHEN s.h IS NULL THEN w.h WHEN w.at % 2 = 0 THEN w.h || s.h ELSE s.h || w.h END),
                 proof || coalesce(s.h, '')
          FROM (SELECT walk.*, CASE WHEN walk.lvl = lvls THEN sub.pos ELSE walk.pos END AS at, lvls,
                  CASE WHEN walk.lvl >= lvls THEN (SELECT max(lvl) FROM top) + lvls ELSE lvls + (SELECT max(lvl) FROM top) END AS last
                FROM walk JOIN sub USING (grp) JOIN (SELECT grp, max(lvl) AS lvls FROM up GROUP BY grp) USING (grp)) AS w
          LEFT JOIN (SELECT grp, lvl, pos, h FROM up WHERE n > 1
                     UNION ALL SELECT sub.grp, lvls + top.lvl, top.pos, top.h FROM top, sub
                       JOIN (SELECT grp, max(lvl) AS lvls FROM up GROUP BY grp) USING (grp) WHERE top.n > 1) AS s
            ON s.grp = w.grp AND s.lvl = w.lvl AND s.pos = xor(w.at, 1)
          WHERE w.lvl < w.last),
        done AS (SELECT id, arg_max(h, lvl) AS folded, arg_max(proof, lvl) AS proof FROM walk GROUP BY id),
        first AS (SELECT row_number() OVER () AS id, * FROM p)
        SELECT doc_id, leaf, sub.h AS subroot, root, folded AS folded_root, folded = root AS verified, sha256(proof) AS proof_sha256
        FROM first JOIN done USING (id) JOIN sub ON sub.grp = first.grp, (SELECT h AS root FROM top WHERE n = 1)""",
    "op12_substring_dedup": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                     regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        w AS (SELECT r, p, md5(array_to_string(ws[p:p + 34], ' ')) AS w FROM d, unnest(range(1, len(ws) - 33)) AS t(p)),
        gone AS (SELECT DISTINCT r, unnest(range(p, p + 35)) AS i
                 FROM (SELECT r, p, count(*) OVER (PARTITION BY w) AS n FROM w) WHERE n > 1),
        kept AS (SELECT r, string_agg(w, ' ' ORDER BY i) AS t
                 FROM (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d) ANTI JOIN gone USING (r, i) GROUP BY r)
        SELECT doc_id, len(ws) AS n_words, coalesce(g, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (r) LEFT JOIN (SELECT r, count(*) AS g FROM gone GROUP BY r) USING (r)""",
}
