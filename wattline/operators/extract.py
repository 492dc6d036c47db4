"""Declarative field extraction from bill text.

``extract_fields`` turns a DataFrame with one text column into the flat bill
record in two projections: the first finds each pattern's raw match once,
the second cleans the (short) matches. A spec with several groups pulls the
whole match first and reads its groups from that short string, so the long
text is scanned once per pattern. A new bill layout is a new ``FieldSpec``
list, not new code.
"""
from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Callable, Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.text import (
    CI, CIM, alnum_only, as_col, compact_id, detect_document_type, digits_only,
    normalize_tarifa, null_if_empty, num_clean, parse_es_date, pystrip, without,
)

Cleaner = Callable[[Column], Column]


@dataclass(frozen=True)
class FieldSpec:
    """``names[i]`` receives group ``i + 1`` of the first match of ``pattern``.

    ``clean`` is applied to each stripped group. A name that already exists
    (from an earlier spec) is a fallback: the earlier value wins when set.

    ``anchor`` is an upper-case literal that every match holds, whatever its
    case, ``before`` characters after its start: the pattern is then matched
    only from the first place of the anchor on. Patterns that look at what is
    before a match further than one character have none.
    """
    names: tuple
    pattern: str
    clean: Optional[Cleaner] = None
    anchor: Optional[str] = None
    before: int = 0


def _spec(names, pattern, clean=None, anchor=None, before=0) -> FieldSpec:
    if isinstance(names, str):
        names = (names,)
    return FieldSpec(tuple(names), pattern, clean, anchor, before)


def _hist_date(c):
    return parse_es_date(c, whole=True)


# The bill layout patterns (Java form of the layout's regexes).
# Quantifiers are possessive wherever what follows can't match what they
# repeat, so runs of blanks are scanned once; tests/test_patterns.py holds the
# plain forms and compares them.
_D = r"[0-9]{1,2}\s+[A-ZÁÉÍÓÚÑ]{3}\s+[0-9]{2,4}"
_N = r"([0-9][0-9,\.]*)"
_NAME = r"[A-ZÁÉÍÓÚÑ0-9\.\-&,/"
_TOTAL = r"TOTAL\s++A\s++PAGAR\s*+"
# A match begins where a run of white space does, so the run is read once; it
# must hold a line start. The second branch is a name of blanks only.
_LINE_START = r"(?<!\s)(?:\A|[^\S\n]*+\n)"
PAT_CLIENTE = (CIM + _LINE_START + r"(?:\s*+(" + _NAME + r"]" + _NAME + r" ]*?)(?<! )\s++" + _TOTAL + r":"
               + r"|(?=[^ \S]*+[ ]\s)\s*+" + _TOTAL + r":)")
PAT_NO_SERVICIO = CI + r"NO\.\s*DE\s*SERVICIO\s*:\s*([0-9 \-]+)"
PAT_CUENTA = CI + r"CUENTA\s*:\s*([A-Z0-9 \-]+)"
PAT_RMU = CI + r"RMU\s*:\s*([0-9 \-]+)"
PAT_RPU = CI + r"\bRPU\s*:\s*([A-Z]{0,3}[0-9 \-]{6,})\b"
PAT_LIMITE = CI + r"L[ÍI]MITE\s+DE\s+PAGO\s*:\s*(" + _D + ")"
PAT_CORTE = CI + r"CORTE\s+A\s+PARTIR\s*:\s*(" + _D + ")"
PAT_PERIODO = CI + r"PERIODO\s+FACTURADO\s*:\s*(" + _D + r")\s*-\s*(" + _D + ")"
PAT_TARIFA = CI + r"\bTARIFA\s*:\s*([A-Z0-9 ]+)"
PAT_TARIFA_CAT = CI + r"\bCATEGOR[ÍI]A\s+TARIFARIA\s+([A-Z0-9]+)\b"
PAT_MEDIDOR = CI + r"\bMEDIDOR\s*:\s*([A-Z0-9\- ]+)\b"
PAT_MULTIPLICADOR = CI + r"\bMULTIPLICADOR\s*:\s*([0-9\.,]+)\b"
PAT_NO_HILOS = CI + r"\bNO\s+HILOS\s*:\s*([0-9]+)\b"
PAT_ENERGY = CI + r"Energ[ií]a\s*\(kWh\)\s*" + _N + r"\s+" + _N + r"\s+" + _N
PAT_KWH_ANY = CI + r"(?<![0-9])(?<![0-9][,\.])([0-9][0-9,\.]*+)\s*+kWh\b"
PAT_IMPORTE = CI + _TOTAL + r":?+\s*+\$?+\s*+" + _N
PAT_CARGO_FIJO = CI + r"Cargo\s+Fijo.*?\s" + _N
PAT_SUBTOTAL_ENERGIA = CI + r"\bEnerg[ií]a\b\s+" + _N
PAT_SUBTOTAL = CI + r"\bSubtotal\b\s+" + _N
PAT_IVA = CI + r"\bIVA\b\s+\d+%?\s+" + _N
PAT_FAC_PERIODO = CI + r"Fac\.\s*del\s*Periodo\s+" + _N
PAT_TOTAL_LINEA = CIM + _LINE_START + r"\s*+Total\s++([0-9][0-9,\.]*+)\s*$"
PAT_HIST_START = r"(?iUd)CONSUMO\s+HIST[ÓO]RICO"
PAT_HIST_STOP = (r"(?iUd)(Datos\s+Fiscales|Cadena\s+Original|Instancias\s+y\s+recursos"
                 r"|Este\s+documento|-2-)")
PAT_HIST_ROW = (r"(?iUd)del\s++(\d{1,2}\s++[A-ZÁÉÍÓÚÑ]{3}\s++\d{2,4})\s++al\s++"
                r"(\d{1,2}\s++[A-ZÁÉÍÓÚÑ]{3}\s++\d{2,4})\s++"
                r"([0-9][0-9,\.]*+)\s++(?:\$\s*+)?+([0-9][0-9,\.]*+)\s++(?:\$\s*+)?+([0-9][0-9,\.]*)")

DEFAULT_SPECS: Sequence[FieldSpec] = (
    _spec("cliente_nombre", PAT_CLIENTE),
    _spec("no_servicio", PAT_NO_SERVICIO, digits_only, "NO."),
    _spec("cuenta", PAT_CUENTA, alnum_only, "CUENTA"),
    _spec("rmu", PAT_RMU, digits_only, "RMU"),
    _spec("rpu", PAT_RPU, compact_id, "RPU"),
    _spec("limite_pago", PAT_LIMITE, parse_es_date, "MITE", 2),
    _spec("corte_a_partir", PAT_CORTE, parse_es_date, "CORTE"),
    _spec(("periodo_inicio", "periodo_fin"), PAT_PERIODO, parse_es_date, "PERIODO"),
    _spec("tarifa", PAT_TARIFA, normalize_tarifa, "TARIFA"),
    _spec("tarifa", PAT_TARIFA_CAT, normalize_tarifa, "CATEGOR"),
    _spec("medidor", PAT_MEDIDOR, alnum_only, "MEDIDOR"),
    _spec("multiplicador", PAT_MULTIPLICADOR, num_clean, "MULTIPLICADOR"),
    _spec("no_hilos", PAT_NO_HILOS, None, "NO"),
    _spec(("lectura_actual_kwh", "lectura_anterior_kwh", "kwh_total"), PAT_ENERGY, num_clean, "ENERG"),
    _spec("kwh_total", PAT_KWH_ANY, num_clean),
    _spec("importe_total", PAT_IMPORTE, num_clean, "TOTAL"),
    _spec("cargo_fijo", PAT_CARGO_FIJO, num_clean, "CARGO"),
    _spec("subtotal_energia", PAT_SUBTOTAL_ENERGIA, num_clean, "ENERG"),
    _spec("subtotal", PAT_SUBTOTAL, num_clean, "SUBTOTAL"),
    _spec("iva", PAT_IVA, num_clean, "IVA"),
    _spec("fac_del_periodo", PAT_FAC_PERIODO, num_clean, "FAC."),
    _spec("total_linea", PAT_TOTAL_LINEA, num_clean),
)

# The letters that a case-blind pattern takes for an ASCII letter though they aren't upper-cased to it.
FOLDED = ["\u0130", "\u212a"]

# Output order of the flat record (the envelope adds its own columns).
FIELD_COLUMNS = [
    "source_utility", "document_type", "cliente_nombre", "no_servicio", "cuenta",
    "rmu", "rpu", "limite_pago", "corte_a_partir", "periodo_inicio", "periodo_fin",
    "tarifa", "medidor", "multiplicador", "no_hilos", "lectura_actual_kwh",
    "lectura_anterior_kwh", "kwh_total", "importe_total", "cargo_fijo",
    "subtotal_energia", "subtotal", "iva", "fac_del_periodo", "total_linea",
    "tiene_consumo_historico", "historico_count", "historico_rows",
]

# Between the groups of a history row; none of them can hold this character.
_DIVIDER = "\x01"

# Fields of a history row.
HISTORY_FIELDS = ["periodo_inicio_raw", "periodo_fin_raw", "periodo_inicio",
                  "periodo_fin", "kwh", "importe", "pagos_pendientes"]


def history_rows(text) -> Column:
    """The consumption-history rows of a text as ``array<string>``.

    The section starts after the first heading and ends at the first footer
    marker; each element is one whole row match, in text order. The groups
    are read later by ``history_row_fields`` in a plain projection (after
    ``posexplode``), where Spark generates code and shares subexpressions;
    inside a lambda it would re-run the row regex for every use.
    """
    parts = F.split(as_col(text), PAT_HIST_START, 2)
    tail = F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit(""))
    section = F.split(tail, PAT_HIST_STOP, 2).getItem(0)
    return F.regexp_extract_all(section, F.lit(PAT_HIST_ROW), 0)


def history_row_groups(rows: DataFrame, match: str, keep: Sequence[str]) -> DataFrame:
    """``keep`` and the five groups ``_h1``..``_h5`` of one history row ``match`` (text; empty where it is no row), numbers bare.

    One run of the pattern gives all groups, divided by a character that none
    of them can hold. They begin and end with digits or points, so there is nothing to strip.
    """
    divided = F.regexp_replace(match, r"(?s)\A.*?" + PAT_HIST_ROW + r"(?s).*\z", _DIVIDER.join(f"${i}" for i in range(1, 6)))
    found = rows.select(*keep, F.split(divided, _DIVIDER).alias("_groups"))
    group = [F.when(F.size("_groups") != 5, F.lit("")).otherwise(F.get("_groups", F.lit(i))) for i in range(5)]
    return found.select(*keep, *[g.alias(f"_h{i + 1}") for i, g in enumerate(group[:2])],
                        *[without(g, "$, ").alias(f"_h{i + 3}") for i, g in enumerate(group[2:])])


def history_row_fields() -> list:
    """Fields of a history row from the ``_h1``..``_h5`` group columns.

    Kept in a projection of its own after ``history_row_groups``: the
    cleaners use their input more than once (inside conditionals, where Spark
    shares no subexpressions), so feeding them attributes keeps the row
    regex at one run per group.
    """
    return [
        F.col("_h1").alias("periodo_inicio_raw"),
        F.col("_h2").alias("periodo_fin_raw"),
        _hist_date("_h1").alias("periodo_inicio"),
        _hist_date("_h2").alias("periodo_fin"),
        *[null_if_empty(pystrip(f"_h{i}")).alias(name) for i, name in ((3, "kwh"), (4, "importe"), (5, "pagos_pendientes"))],
    ]


EVIDENCE = "struct<snippet:string,offset:int>"


def snippets(spec: FieldSpec, i: int) -> Column:
    """(snippet, offset) of each group of a spec, from its match ``_match<i>`` at ``_begin<i>``.

    A group that ends its pattern is found from the match's end, the groups
    before it from there to the left, and a group that doesn't from the start.
    """
    match, found, end = F.col(f"_match{i}"), [], None
    trailing = not spec.pattern.rstrip("$").endswith(":)")
    for j in range(len(spec.names), 0, -1):
        # A word boundary after the match may be needed to find its only group: that one was read in the text.
        v = pystrip(F.col(f"_raw{i}") if len(spec.names) == 1 else F.regexp_extract(match, spec.pattern, j))
        part = match if end is None else F.substr(match, F.lit(1), end - 1)
        last = F.length(part) - F.length(v) + 2 - F.position(F.reverse(v), F.reverse(part)) if trailing else F.position(v, part)
        end = last
        found.append(F.struct(v.alias("snippet"), (F.col(f"_begin{i}") + last - 1).cast("int").alias("offset")))
    return F.array(*found[::-1])


def extract_fields(df: DataFrame, text_col: str = "text",
                   specs: Sequence[FieldSpec] = DEFAULT_SPECS,
                   keep: Optional[Sequence[str]] = None, evidence: bool = False) -> DataFrame:
    """Add the flat bill fields (and ``historico_rows``) to ``df``.

    ``keep`` limits the carried input columns (default: all but the text is
    kept; callers drop the text right after to keep shuffles narrow).
    ``evidence`` adds a map from each field that was found to the snippet of
    the text it was read from and the snippet's place (from 1).
    """
    text = F.col(text_col)
    carried = list(keep) if keep is not None else [c for c in df.columns if c != text_col]
    seen: set = set()
    primary, fallback = [], []
    for i, spec in enumerate(specs):
        (fallback if set(spec.names) & seen else primary).append(i)
        seen.update(spec.names)

    # Projection 1: the upper-cased text and the first place of each anchor in
    # it. Places are those of the text itself where upper-casing keeps the
    # number of characters (it never lowers it); two letters fold to ASCII
    # ones without being upper-cased to them. Other texts are matched whole.
    # Projection 2: one match per primary spec, from its anchor on, with a
    # character before it for word boundaries; a fallback pattern is tried
    # only where its primary value is missing (the guard shares the primary
    # match with its own column).
    def start_of(i):
        return F.col(starts[specs[i].anchor, specs[i].before])

    def rest_of(i):
        """The text from where a match can begin; empty if its anchor isn't there."""
        return text if specs[i].anchor is None else F.substr(text, start_of(i))

    def raw_of(i):
        return F.regexp_extract(rest_of(i), specs[i].pattern, 1 if len(specs[i].names) == 1 else 0)

    def groups(i, raw):
        spec = specs[i]
        out = []
        for j, name in enumerate(spec.names):
            g = raw if len(spec.names) == 1 else F.regexp_extract(raw, spec.pattern, j + 1)
            v = null_if_empty(pystrip(g))
            out.append((name, spec.clean(v) if spec.clean is not None else v))
        return out

    up = df.select(*[F.col(c) for c in carried], text.alias("_text"),
                   F.upper(F.coalesce(text, F.lit(""))).alias("_up"))
    text = F.col("_text")
    places = {a: f"_place{k}" for k, a in enumerate(sorted({spec.anchor for spec in specs if spec.anchor}))}
    length = F.length(F.coalesce(text, F.lit("")))
    aligned = (F.length("_up") == length) & ~reduce(lambda a, b: a | b, [F.contains("_up", F.lit(ch)) for ch in FOLDED])
    up = up.select("*", aligned.alias("_aligned"), length.alias("_length"), *[F.instr("_up", a).alias(name) for a, name in places.items()])
    starts = {key: f"_start{k}" for k, key in enumerate(sorted({(spec.anchor, spec.before) for spec in specs if spec.anchor}))}
    up = up.select(*[F.col(c) for c in carried], "_text", "_up", *[
        F.when(~F.col("_aligned"), F.lit(1)).when(F.col(places[a]) > 0, F.greatest(F.col(places[a]) - (before + 1), F.lit(1)))
        .otherwise(F.col("_length") + 1).alias(name) for (a, before), name in starts.items()])
    doc = detect_document_type(text, F.col("_up"))
    hist = F.when(doc.getField("document_type") == "cfe_bill", history_rows(text)) \
        .otherwise(F.array().cast("array<string>"))
    first_of = {}
    for i in primary:
        for name in specs[i].names:
            first_of.setdefault(name, i)
    stage1 = [raw_of(i).alias(f"_raw{i}") for i in primary]
    for i in fallback:
        missing = []
        for name in specs[i].names:
            k = first_of[name]
            val = dict(groups(k, raw_of(k)))[name]
            missing.append(val.isNull())
        guard = reduce(lambda a, b: a | b, missing)
        stage1.append(F.when(guard, raw_of(i)).alias(f"_raw{i}"))
    if evidence:
        for i in primary + fallback:
            # What is before the match, in characters (regexp_instr counts UTF-16 units), and the match: all that isn't before or after it.
            around = F.split(rest_of(i), specs[i].pattern, 2)
            begin = F.length(F.get(around, F.lit(0))) + 1
            stage1.append((begin if specs[i].anchor is None else begin + start_of(i) - 1).alias(f"_begin{i}"))
            stage1.append(F.substr(rest_of(i), begin, F.length(rest_of(i)) - F.length(F.get(around, F.lit(1))) - begin + 1).alias(f"_match{i}"))
    stage = up.select(*[F.col(c) for c in carried], doc.alias("_doc"), hist.alias("_hist"),
                      *stage1)

    # Projection 3: groups of multi-group matches, cleaning, fallbacks.
    values: dict[str, Column] = {}
    flags: list[Column] = []
    read: dict[str, list[Column]] = {}
    for i in primary + fallback:
        for j, (name, v) in enumerate(groups(i, F.col(f"_raw{i}"))):
            values[name] = F.coalesce(values[name], v) if name in values else v
            flags.append(v.isNotNull().alias(f"_has{i}_{j}"))
            read.setdefault(name, []).append(F.when(F.col(f"_has{i}_{j}"), F.get(f"_seen{i}", F.lit(j))))
    passed = [*[F.col(c) for c in carried], F.col("_doc"), F.col("_hist")]
    if evidence:
        # Projections of their own: the map's entries are read in interpreted code, which shares no subexpressions.
        stage = stage.select("*", *[snippets(specs[i], i).alias(f"_seen{i}") for i in primary + fallback])
        stage2 = stage.select(*passed, *[v.alias(n) for n, v in values.items()], *flags, *[F.col(f"_seen{i}") for i in primary + fallback])
        entries = [F.when(F.col(name).isNotNull(), F.struct(F.lit(name).alias("key"), F.coalesce(*seen).alias("value")))
                   for name, seen in read.items()]
        stage2 = stage2.select(*passed, *values, F.map_from_entries(F.array_compact(F.array(*entries))).alias("_evidence"))
    else:
        stage2 = stage.select(*passed, *[v.alias(n) for n, v in values.items()])

    out_cols = [F.col(c) for c in carried]
    out_cols.append(F.col("_doc.source_utility").alias("source_utility"))
    out_cols.append(F.col("_doc.document_type").alias("document_type"))
    for name in FIELD_COLUMNS[2:-3]:
        out_cols.append(F.col(name) if name in stage2.columns
                        else F.lit(None).cast("string").alias(name))
    out_cols.append((F.size("_hist") > 0).alias("tiene_consumo_historico"))
    out_cols.append(F.size("_hist").cast("int").alias("historico_count"))
    out_cols.append(F.col("_hist").alias("historico_rows"))
    if evidence:
        out_cols.append(F.col("_evidence").alias("evidence"))
    return stage2.select(*out_cols)
