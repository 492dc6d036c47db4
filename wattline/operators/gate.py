"""Page assembly, text-quality gate and text-source choice.

The gate is one ordered ``CASE WHEN`` over per-text features (length, cid
tokens, utility anchors, share of odd symbols); Spark evaluates the branches
lazily in order, like the reference's early returns.
"""
from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.text import as_col, pystrip

# Characters that never count as odd symbols in the gate.
GATE_ALLOWED = " \n\r\t.,:;/-_()[]$%+°º'\""
# The CFE anchor words (plus the service-number regex).
STRONG_ANCHORS = ["TARIFA", "CUENTA", "MEDIDOR", "RPU"]
ANCHOR_SERVICE = r"(?U)NO\.?\s+DE\s+SERVICIO"
# Letters and digits one by one: a Java class looks such characters up in one table, properties are asked one after another.
ASCII_ALNUM = string.ascii_letters + string.digits
WEIRD_RATIO_MAX = 0.35
CID_MAX = 50


def assemble_text(pages: DataFrame, max_pages: int = 2, key: str = "file_path",
                  skip_empty: bool = False) -> DataFrame:
    """Join the first ``max_pages`` page texts of each document by ``\\n``.

    ``pages`` has (``key``, ``page_no``, ``text``). The page filter is pushed
    to the scan; a missing page text counts as ``''``; the result is stripped.
    ``skip_empty=True`` leaves empty pages out (how the OCR side joins pages).
    A page without a key belongs to no document and is left out (count them
    with ``keyless_pages``). Of pages that repeat a number the largest text
    counts. Each page number has its own aggregate column, so a document never
    gathers more than ``max_pages`` texts whatever its share of the input.
    """
    p = pages.where(F.col("page_no").between(1, max_pages) & F.col(key).isNotNull())
    txt = F.coalesce(F.col("text"), F.lit(""))
    if skip_empty:
        p = p.where(txt != "")
    numbers = range(1, max_pages + 1)
    agg = p.groupBy(key).agg(*[F.max(F.when(F.col("page_no") == i, txt)).alias(f"_page{i}") for i in numbers])
    return agg.select(key, joined_pages(*[F.col(f"_page{i}") for i in numbers]).alias("text"))


def joined_pages(*texts: Column) -> Column:
    """The text of a document from its pages in order; a page that isn't there (null) is left out."""
    return pystrip(F.concat_ws("\n", *texts))


def keyless_pages(pages: DataFrame, key: str = "file_path") -> DataFrame:
    """How many pages name no document (one row)."""
    return pages.agg(F.count_if(F.col(key).isNull()).alias("keyless_pages"))


def _count_outside(s: Column, keep_class: str) -> Column:
    """Number of characters of ``s`` not in the regex class ``keep_class``."""
    return F.length(F.regexp_replace(s, "[" + keep_class + "]+", ""))


def gate_features(text) -> list:
    """Per-text gate features (one pass each over the stripped text)."""
    raw = as_col(text)
    s = pystrip(raw)
    up = F.upper(s)
    return [*_marks(raw, s, up), (_words(up) + _service(up)).alias("_g_hits"),
            _letters(s).alias("_g_letters"), _weird(s).alias("_g_weird")]


def _marks(raw: Column, s: Column, up: Column) -> list:
    return [
        raw.isNull().alias("_g_null"),
        F.length(s).alias("_g_len"),
        F.when(s.contains("cid:"), F.regexp_count(s, F.lit(r"(?U)cid:\d+"))).when(s.isNotNull(), F.lit(0)).alias("_g_cid"),
        up.contains("IBERDROLA").alias("_g_iber"),
        ((up.contains("CATEGOR") & up.contains("TARIF"))
         | up.contains("DIVISIÓN TARIFARIA") | up.contains("DIVISION TARIFARIA")).alias("_g_iber_ok"),
    ]


def _words(up: Column) -> Column:
    return sum(up.contains(a).cast("int") for a in STRONG_ANCHORS)


def _service(up: Column) -> Column:
    return up.rlike(ANCHOR_SERVICE).cast("int")


def _letters(s: Column) -> Column:
    return _count_outside(s, r"^\p{L}")


def _weird(s: Column) -> Column:
    allowed = "".join("\\" + ch if ch in "[]\\^-" else ch for ch in GATE_ALLOWED)
    return _count_outside(s, ASCII_ALNUM + allowed + r"\p{L}\p{N}")


def with_needed_features(df: DataFrame, text) -> DataFrame:
    """``df`` with the features, for the rules alone: what can't change their result isn't computed.

    A text with two anchor words passes whether or not it has a service number,
    and one without odd symbols whatever its letters (0 here). Anchor words that
    stand in the text as they are also stand in the upper-cased one, so with two
    of them only IBERDROLA can need that; no character but r, d, R and D turns
    into its "RD". Each step is a projection of its own: an expression read more
    than once, also inside a condition, is then computed once.
    """
    raw, s, up, words, weird = as_col(text), F.col("_g_text"), F.col("_g_up"), F.col("_g_words"), F.col("_g_weird")
    steps = df.select("*", pystrip(raw).alias("_g_text")).select("*", _words(s).alias("_g_words"), _weird(s).alias("_g_weird"))
    upper = (words < 2) | reduce(lambda a, b: a | b, [s.contains(p) for p in ("RD", "rd", "Rd", "rD")])
    steps = steps.select("*", F.when(upper, F.upper(s)).otherwise(F.lit("")).alias("_g_up"))
    return steps.select(
        *df.columns, *_marks(raw, s, up),
        F.when(words < 2, _words(up) + _service(up)).otherwise(words).alias("_g_hits"),
        F.when(weird > 0, _letters(s)).otherwise(F.lit(0)).alias("_g_letters"), weird)


GATE_FEATURES = ["_g_null", "_g_len", "_g_cid", "_g_iber", "_g_iber_ok", "_g_hits",
                 "_g_letters", "_g_weird"]


def _two_places(num: Column, den: Column, ratio: Column) -> Column:
    """The double ``num / den`` with two decimals, rounded by its exact binary value.

    Off a tie the exact quotient decides. On a tie the double lies on one side
    of it: its halves of at most 27 bits, times 200, are exact, and the sign of
    what they differ from the odd number 200 ratio stands for tells the side.
    """
    hundred = num.cast("long") * 100
    low, rest = F.floor(hundred / den), hundred % den
    low = F.when(low * den > hundred, low - 1).otherwise(low)
    split = ratio * F.lit(134217729.0)
    high = split - (split - ratio)
    side = (high * 200 - (low * 2 + 1).cast("double")) + (ratio - high) * 200
    up = (rest * 2 > den) | ((rest * 2 == den) & ((side > 0) | ((side == 0) & (low % 2 == 1))))
    value = low + up.cast("long")
    return F.concat(F.floor(value / 100).cast("string"), F.lit("."), F.lpad((value % 100).cast("string"), 2, "0"))


def gate_reason(min_chars: int = 80) -> Column:
    """The ordered rule list over the ``gate_features`` columns."""
    c = F.col
    letters1 = F.greatest(c("_g_letters"), F.lit(1))
    ratio = c("_g_weird").cast("double") / letters1.cast("double")
    ratio_txt = _two_places(c("_g_weird"), letters1, ratio)
    return (
        F.when(c("_g_null"), F.lit("none_text"))
        .when(c("_g_len") < min_chars, F.lit(f"too_short<{min_chars}"))
        .when(c("_g_cid") >= CID_MAX, F.format_string("cid_garbage(%d)", c("_g_cid")))
        .when(c("_g_iber"), F.when(c("_g_iber_ok"), F.lit("ok_iberdrola"))
              .otherwise(F.lit("iberdrola_missing_anchors")))
        .when(c("_g_hits") < 2, F.format_string("missing_strong_anchors(%d)", c("_g_hits")))
        .when((c("_g_letters") > 0) & (ratio > WEIRD_RATIO_MAX),
              F.concat(F.lit("weird_ratio>"), ratio_txt))
        .otherwise(F.lit("ok"))
    )


def text_gate(df: DataFrame, text_col: str = "text", min_chars: int = 80, lengths: bool = False) -> DataFrame:
    """Add ``gate_reason`` and ``force_ocr`` for ``text_col``; with ``lengths`` also ``embedded_text_len``.

    Features are computed in one projection and the ordered rules read them
    in the next: Spark does not share subexpressions across the branches of
    a ``CASE WHEN``, so inlining the features would strip and upper-case
    the whole text once per rule.
    """
    feats = with_needed_features(df, text_col)
    length = [F.col("_g_len").alias("embedded_text_len")] if lengths else []
    return feats.select(*df.columns, gate_reason(min_chars).alias("gate_reason"), *length) \
        .withColumn("force_ocr", ~F.col("gate_reason").isin("ok", "ok_iberdrola"))


def forced_only(alternate_pages: DataFrame, gated: DataFrame, key: str = "file_path") -> DataFrame:
    """The alternate pages of the keys that the gate forces; their texts are the only ones needed.

    The flag goes through ``explode``: a filter on it would be pushed through
    the gate's projections, and all its rules with their features inlined in
    one condition are too much code for one generated method.
    """
    forced = gated.select(key, F.explode(F.array("force_ocr")).alias("forced")).where("forced").select(key)
    return alternate_pages.join(forced, key, "left_semi")


def choose_text_source(gated: DataFrame, alternate: DataFrame | None,
                       key: str = "file_path", text_col: str = "text") -> DataFrame:
    """Forced rows take the alternate text (``''`` when there is none).

    Adds ``used_ocr``, ``text_source``, ``embedded_text_len`` and
    ``final_text`` / ``text_len``. ``alternate`` is (``key``, ``alt_text``),
    already assembled; both inputs come out of a group-by on ``key``, so the
    join needs no extra exchange of the (wide) embedded text. Pass it through
    ``forced_only`` before assembly to read the alternates of forced keys only.
    """
    if alternate is None:
        alt = F.lit(None).cast("string")
        j = gated
    else:
        j = gated.join(alternate, key, "left")
        alt = F.col("alt_text")
    force = F.col("force_ocr")
    final = F.when(force, F.coalesce(alt, F.lit(""))).otherwise(F.col(text_col))
    # The gate has stripped the text already: its length is taken from there, and only forced rows are measured anew.
    known = "embedded_text_len" in gated.columns
    length = F.col("embedded_text_len") if known else F.length(pystrip(F.col(text_col)))
    out = j.select(
        *[c for c in gated.columns if c not in (text_col, "embedded_text_len")],
        length.alias("embedded_text_len"),
        force.alias("used_ocr"),
        F.when(force, F.lit("ocr")).otherwise(F.lit("pdfplumber")).alias("text_source"),
        final.alias(text_col),
    )
    return out.withColumn("text_len", F.when(F.col("used_ocr"), F.length(pystrip(F.col(text_col)))).otherwise(F.col("embedded_text_len")))
