"""Mall and tenant fingerprints.

Inputs are the parsed bills (fields as text); numbers are coerced with
``safe_numeric`` first. Missing group keys are kept as their own group
(pandas ``dropna=False``). All groupings use partial (map-side)
aggregation, so a mall or tenant holding a large share of the bills costs
one small partial row per map task, not a hot reducer. Division by zero
gives NULL.
"""
from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.functions.numeric import months_span, safe_numeric, to_date_or_null
from wattline.operators.percentiles import percentiles
from wattline.session import stored, where_computed

MALL_KEYS = ["mall_folder", "recibos_subgroup"]
TENANT_KEYS = ["mall_folder", "recibos_subgroup", "medidor"]
NAN_LABEL = "nan"


def require_columns(df: DataFrame, required: Sequence[str], who: str) -> None:
    """Fail early naming the missing columns, sorted."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{who} missing columns: {missing}")


def first_present(df: DataFrame, candidates: Sequence[str]) -> Optional[str]:
    """The first of the candidate names that is a column."""
    for name in candidates:
        if name in df.columns:
            return name
    return None


def normalize_columns(df: DataFrame) -> DataFrame:
    """Strip blanks around column names."""
    return df.toDF(*[c.strip() for c in df.columns])


def mxn_per_kwh(kwh: Column, importe: Column) -> Column:
    """Importe / kwh only for kwh > 0 with importe present."""
    return F.when(kwh.isNotNull() & (kwh > 0) & importe.isNotNull(), importe / kwh)


def _typed(bills: DataFrame) -> DataFrame:
    kwh = safe_numeric("kwh_total")
    imp = safe_numeric("importe_total")
    cols = [F.col(c) for c in bills.columns if c not in ("kwh_total", "importe_total")]
    return bills.select(*cols, kwh.alias("kwh_total"), imp.alias("importe_total")) \
        .withColumn("mxn_per_kwh", mxn_per_kwh(F.col("kwh_total"), F.col("importe_total")))


def _tariff_meter_groups(bills: DataFrame) -> DataFrame:
    """Sums by (mall, subgroup) and tariff label (kind 0), and by (mall, subgroup) and meter (kind 1).

    Bills are read and reduced once, by tariff and meter; both groupings work on
    that small result.
    """
    label = F.coalesce(F.col("tarifa").cast("string"), F.lit(NAN_LABEL))
    x = _typed(bills.select(*MALL_KEYS, "medidor", "kwh_total", "importe_total", label.alias("tarifa")))
    base = x.groupBy(*MALL_KEYS, "tarifa", "medidor").agg(
        F.count(F.lit(1)).alias("rows"), F.count("kwh_total").alias("bills"), F.sum("kwh_total").alias("kwh"),
        F.sum("importe_total").alias("importe"), F.sum("mxn_per_kwh").alias("mxn"), F.count("mxn_per_kwh").alias("mxn_bills"))
    sums = ["rows", "bills", "kwh", "importe", "mxn", "mxn_bills"]
    kinds = F.array(F.struct(F.lit(0).alias("kind"), F.col("tarifa").alias("name")),
                    F.struct(F.lit(1).alias("kind"), F.col("medidor").alias("name")))
    each = base.select(*MALL_KEYS, *sums, F.explode(kinds).alias("k")).select(*MALL_KEYS, *sums, "k.*")
    return each.groupBy(*MALL_KEYS, "kind", "name").agg(*[F.sum(c).alias(c) for c in sums])


def _roll_aggregates() -> list:
    meter = F.col("kind") == 1

    def total(c):
        return F.sum(F.when(meter, F.col(c)))
    kwh, importe = F.coalesce(total("kwh"), F.lit(0.0)), F.coalesce(total("importe"), F.lit(0.0))
    meters = F.count(F.when(meter, F.col("name")))
    return [
        total("bills").alias("bills"), meters.alias("meters"), kwh.alias("kwh_sum"),
        F.try_divide(total("kwh"), total("bills")).alias("kwh_mean_bill"), importe.alias("importe_sum"),
        F.try_divide(total("mxn"), total("mxn_bills")).alias("mxn_per_kwh_mean"),
        F.try_divide(kwh, meters).alias("kwh_per_meter"),
    ]


def _keys_present() -> Column:
    return F.col("mall_folder").isNotNull() & F.col("recibos_subgroup").isNotNull()


def _share_columns(tariffs: Sequence[str]) -> list:
    """One share per listed label over the rows of a group; any other label stops the query."""
    tariff, total = F.col("kind") == 0, F.sum(F.when(F.col("kind") == 0, F.col("rows")))
    listed = F.when(~tariff | F.col("name").isin(*tariffs), F.lit(0)).otherwise(
        F.raise_error(F.concat(F.lit("tariff label not in the list: "), F.col("name"))).cast("int"))
    # The check is a part of every share (it adds 0), so no plan can leave it out.
    return [((F.coalesce(F.sum(F.when(tariff & (F.col("name") == t), F.col("rows"))), F.lit(0)) + F.sum(listed)) / total)
            .alias(f"share_{t}") for t in tariffs]


def _share_map() -> Column:
    tariff, total = F.col("kind") == 0, F.sum(F.when(F.col("kind") == 0, F.col("rows")))
    counts = F.array_sort(F.collect_list(F.when(tariff, F.struct("name", "rows"))))
    return F.map_from_entries(F.transform(counts, lambda e: F.struct(e["name"], e["rows"] / total)))


def mall_rollup(bills: DataFrame) -> DataFrame:
    """A1 (+P23): one row per (mall, subgroup)."""
    require_columns(bills, MALL_KEYS + ["medidor", "kwh_total", "importe_total"], "mall rollup")
    x = _typed(bills.select(*MALL_KEYS, "medidor", "kwh_total", "importe_total"))
    out = x.groupBy(*MALL_KEYS).agg(
        F.count("kwh_total").alias("bills"),
        F.count_distinct("medidor").alias("meters"),
        F.coalesce(F.sum("kwh_total"), F.lit(0.0)).alias("kwh_sum"),
        F.avg("kwh_total").alias("kwh_mean_bill"),
        F.coalesce(F.sum("importe_total"), F.lit(0.0)).alias("importe_sum"),
        F.avg("mxn_per_kwh").alias("mxn_per_kwh_mean"),
    )
    return out.withColumn("kwh_per_meter", F.try_divide(F.col("kwh_sum"), F.col("meters")))


def tariff_shares(bills: DataFrame) -> DataFrame:
    """Bills per (mall, subgroup, tariff label) and share of the group.

    The label of a missing tariff is ``'nan'``. The group total ignores
    groups with a missing key, so their shares are NULL. The window runs on
    the already aggregated counts (groups x tariffs rows).
    """
    label = F.coalesce(F.col("tarifa").cast("string"), F.lit(NAN_LABEL))
    counts = bills.groupBy(*MALL_KEYS, label.alias("tarifa")).agg(
        F.count(F.lit(1)).alias("tarifa_bills"))
    total = F.sum("tarifa_bills").over(Window.partitionBy(*MALL_KEYS))
    keys_ok = F.col("mall_folder").isNotNull() & F.col("recibos_subgroup").isNotNull()
    return counts.select(
        *MALL_KEYS, "tarifa", "tarifa_bills",
        F.when(keys_ok, total).alias("tarifa_bills_total"),
        F.when(keys_ok, F.col("tarifa_bills") / total).alias("tarifa_share"),
    )


def tariff_pivot(bills: DataFrame, tariffs: Sequence[str]) -> DataFrame:
    """A4, wide form: ``share_<tariff>`` per (mall, subgroup) for the listed labels; absent tariff = 0.

    Labels are free text, so the columns are the caller's: a label that isn't
    listed fails the query. Only groups with both keys present appear.
    """
    shares = tariff_shares(bills).where(_keys_present())
    rows = shares.select(*MALL_KEYS, F.lit(0).alias("kind"), F.col("tarifa").alias("name"), F.col("tarifa_bills").alias("rows"))
    return rows.groupBy(*MALL_KEYS).agg(*_share_columns(tariffs))


def tariff_map(bills: DataFrame) -> DataFrame:
    """A4, map form: (mall, subgroup, shares by label) with no dynamic columns."""
    shares = tariff_shares(bills).where(_keys_present())
    return shares.groupBy(*MALL_KEYS).agg(F.map_from_entries(F.array_sort(F.collect_list(
        F.struct("tarifa", "tarifa_share")))).alias("tarifa_shares"))


def mall_fingerprints(bills: DataFrame, tariffs: Optional[Sequence[str]] = None,
                      sort: bool = False) -> DataFrame:
    """The rollup with the tariff shares of each (mall, subgroup).

    Shares come as a map by label, or as one column per label of ``tariffs``.
    Both parts derive from one reduction of the bills, so nothing is joined and
    no job runs before the caller's.
    """
    require_columns(bills, MALL_KEYS + ["medidor", "kwh_total", "importe_total", "tarifa"], "mall fingerprints")
    groups = _tariff_meter_groups(bills).groupBy(*MALL_KEYS)
    if tariffs is None:
        out = groups.agg(*_roll_aggregates(), _share_map().alias("tarifa_shares")) \
            .withColumn("tarifa_shares", F.when(_keys_present(), F.col("tarifa_shares")))
    else:
        out = groups.agg(*_roll_aggregates(), *_share_columns(tariffs))
        for t in tariffs:
            out = out.withColumn(f"share_{t}", F.when(_keys_present(), F.col(f"share_{t}")))
    return out.orderBy(*[F.asc_nulls_last(k) for k in MALL_KEYS]) if sort else out


def tenant_fingerprints(bills: DataFrame, sort: bool = False) -> DataFrame:
    """One row per (mall, subgroup, medidor).

    First/last period dates come out NULL for a group with a missing key
    (the reference takes them from a group-by that drops such groups). The
    mode comes from counts by label and the exact medians from counts by
    value, so the group of all bills without a meter is never in one task.
    """
    require_columns(bills, TENANT_KEYS + ["kwh_total", "importe_total", "tarifa"], "tenant fingerprints")
    has_ini, has_fin = ("periodo_inicio" in bills.columns, "periodo_fin" in bills.columns)
    dates = [c for c, has in (("periodo_inicio", has_ini), ("periodo_fin", has_fin)) if has]
    x = _typed(bills.select(*TENANT_KEYS, F.col("tarifa").cast("string").alias("tarifa"), "kwh_total", "importe_total", *dates))
    # Read for the sums and for the medians: what gives the few columns runs once.
    x = stored(x, "tenants")
    values = [("kwh", "kwh_total"), ("importe", "importe_total"), ("mxn", "mxn_per_kwh")]
    span = ([F.min(to_date_or_null("periodo_inicio")).alias("_first")] if has_ini else []) \
        + ([F.max(to_date_or_null("periodo_fin")).alias("_last")] if has_fin else [])
    base = x.groupBy(*TENANT_KEYS, "tarifa").agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(f"{n}_sum") for n, c in values],
        *[F.count(c).alias(f"{n}_n") for n, c in values], *span)
    most = F.min(F.when(F.col("tarifa").isNotNull(), F.struct((-F.col("rows")).alias("n"), "tarifa")))
    means = [F.try_divide(F.sum(f"{n}_sum"), F.sum(f"{n}_n")) for n, _ in values]
    out = base.groupBy(*TENANT_KEYS).agg(
        most["tarifa"].alias("tarifa_mode"),
        F.sum("kwh_n").alias("bills_count"),
        F.coalesce(F.sum("kwh_sum"), F.lit(0.0)).alias("kwh_sum"), means[0].alias("kwh_mean"),
        F.coalesce(F.sum("importe_sum"), F.lit(0.0)).alias("importe_sum"), means[1].alias("importe_mean"),
        means[2].alias("mxn_per_kwh_mean"),
        *([F.min("_first").alias("_first")] if has_ini else []), *([F.max("_last").alias("_last")] if has_fin else []))
    keys_ok = _keys_present() & F.col("medidor").isNotNull()
    if has_ini:
        out = out.withColumn("first_periodo_inicio", F.when(keys_ok, F.col("_first"))).drop("_first")
    if has_fin:
        out = out.withColumn("last_periodo_fin", F.when(keys_ok, F.col("_last"))).drop("_last")
    if has_ini and has_fin:
        out = out.withColumn("months_span", months_span("first_periodo_inicio", "last_periodo_fin"))
    medians = {"kwh_median": "kwh_total", "mxn_per_kwh_median": "mxn_per_kwh"}
    pairs = F.array(*[F.struct(F.lit(name).alias("name"), F.col(c).alias("v")) for name, c in medians.items()])
    each = x.select(*TENANT_KEYS, F.explode(pairs).alias("p")).select(*TENANT_KEYS, "p.*")
    found = percentiles(each, TENANT_KEYS + ["name"], "v", {"median": 0.5})
    found = found.groupBy(F.struct(*[F.col(f"key.{k}").alias(k) for k in TENANT_KEYS]).alias("key")).agg(
        *[F.max(F.when(F.col("key.name") == name, F.col("median"))).alias(name) for name in medians])
    out = out.withColumn("key", F.struct(*TENANT_KEYS)).join(found, "key", "left").drop("key")
    return out.orderBy(*[F.asc_nulls_last(k) for k in TENANT_KEYS]) if sort else out


def meter_profile(df: DataFrame, meter: str, kwh: str, kw: Optional[str] = None,
                  hours: float = 720.0) -> DataFrame:
    """Per meter (missing dropped) avg kWh, avg kW, bills, load factor.

    ``bills`` counts rows (missing kWh included); load factor =
    avg_kwh / (avg_kw * hours), NULL when the denominator is 0 or missing.
    """
    x = where_computed(df, F.col(meter).isNotNull()).select(
        F.col(meter).alias("medidor"), safe_numeric(kwh).alias("_kwh"),
        *( [safe_numeric(kw).alias("_kw")] if kw else []))
    aggs = [F.avg("_kwh").alias("avg_kwh")]
    if kw:
        aggs.append(F.avg("_kw").alias("avg_kw"))
    aggs.append(F.count(F.lit(1)).alias("bills"))
    out = x.groupBy("medidor").agg(*aggs)
    if kw:
        out = out.withColumn("load_factor", F.try_divide(
            F.col("avg_kwh"), F.col("avg_kw") * F.lit(float(hours))))
    return out
