"""Bill inputs rendered from the driver's TPC-H-style tables (FIXTURES.md).

The reference reads PDF bills from a folder tree. Those files do not exist
here, so this source derives them, at any scale, from ``orders ⋈ customer ⋈
nation`` (one bill per order) and ``lineitem`` (one history row per line):

* ``listing``         (file_path)                      -- the folder listing
* ``pages``           (file_path, page_no, text)       -- embedded page texts
* ``alternate_pages`` (file_path, page_no, text)       -- clean re-read texts

Every expected field is a plain function of the source columns, so an
independent SQL engine can check the parse without parsing anything.
``cls = o_orderkey % 100`` picks a dirt class (FIXTURES.md §3).

Scale notes: the only wide operation is exchanging ``lineitem`` by order to
render the history page; a bill's history is one document, so its size is
that order's line count (TPC-H bounds it), and partial aggregation is not
possible for ordered string concatenation. The orders side joins customer
and nation on their keys; Spark/AQE choose broadcast only from measured
sizes (``autoBroadcastJoinThreshold``), never from a hint.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattline.functions.text import es_date_text

# Fixed values of the rendering (FIXTURES.md §2).
ROOT = "/bills"
BILLS_FOLDER = "7. Recibos CFE"
DAY_SHIFT = 9131
TARIFFS_BY_PRIORITY = ["PDBT", "GDBT", "GDMTO", "GDMTH", "DB1"]
CID_TOKEN = "(cid:12)"
CID_REPEAT = 60
PIPE_REPEAT = 4000
FORCED_WITH_ALTERNATE = [0, 1, 3, 5]


@dataclass
class BillSources:
    src: DataFrame            # one row per order with the rendering inputs
    listing: DataFrame        # file_path
    pages: DataFrame          # file_path, page_no, text
    alternate_pages: DataFrame


def _fmt0(c: Column) -> Column:
    return F.format_number(c, 0)


def _fmt2(c: Column) -> Column:
    return F.format_number(c, 2)


def _digits(name: str, n: int) -> Column:
    """``%0nd``; the formatter itself is only called where padding gives another text."""
    c = F.col(name)
    return F.when((c >= 0) & (c < 10 ** n), F.lpad(c.cast("string"), n, "0")).otherwise(F.format_string(f"%0{n}d", c))


def _line_date(d: Column) -> Column:
    """The date of a history line; empty if there is none."""
    return F.when(d.isNotNull(), es_date_text(d)).otherwise(F.lit(""))


def bill_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with every value the bill layout needs."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        "c_custkey", "c_nationkey", "c_mktsegment")
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    j = (o.join(c, o.o_custkey == c.c_custkey)
         .join(n, c.c_nationkey == n.n_nationkey))
    key = F.col("o_orderkey")
    cls = (key % 100).cast("int")
    ini = F.date_add(F.to_date("o_orderdate"), DAY_SHIFT)
    prio = (F.substring("o_orderpriority", 1, 1)).try_cast("int")
    tariff = F.try_element_at(F.array(*[F.lit(t) for t in TARIFFS_BY_PRIORITY]), prio)
    # Exchanged by key before anything is rendered: the texts are made by even tasks, also when
    # AQE broadcasts the lines and the orders come from a file that one task scans.
    return j.repartition("o_orderkey").select(
        key.alias("okey"),
        F.col("o_custkey").alias("ck"),
        cls.alias("cls"),
        F.col("n_name").alias("mall"),
        F.col("c_mktsegment").alias("seg"),
        ini.alias("ini"),
        F.when(key % 97 == 0, F.date_sub(ini, 5))
         .otherwise(F.date_add(ini, (key % 62).cast("int"))).alias("fin"),
        F.when(cls == 10, F.lit(0)).otherwise(100 + key % 9000).cast("long").alias("kwh"),
        F.col("o_totalprice").alias("total"),
        tariff.alias("tariff"),
    )


def _file_path(cls: Column) -> Column:
    year = F.year("ini").cast("string")
    name = F.col("okey").cast("string")
    base = F.concat(F.lit(ROOT + "/"), F.col("mall"))
    bills = F.concat(base, F.lit("/" + BILLS_FOLDER))
    std = F.concat(bills, F.lit("/"), F.col("seg"), F.lit("/"), year, F.lit("/"), name)
    return (
        F.when(cls == 11, F.concat(base, F.lit("/Otros/"), F.col("seg"), F.lit("/"),
                                   year, F.lit("/"), name, F.lit(".pdf")))
        .when(cls == 12, F.concat(bills, F.lit("/"), F.col("seg"), F.lit("/1985-"), year,
                                  F.lit("/"), year, F.lit("/"), name, F.lit(".pdf")))
        .when(cls == 13, F.concat(bills, F.lit("/"), name, F.lit(".pdf")))
        .when(cls == 14, F.concat(std, F.lit(".PDF")))
        .otherwise(F.concat(std, F.lit(".pdf")))
    )


def _page1(cls: Column) -> Column:
    total = F.concat(F.lit("$"), _fmt2(F.col("total")))
    key12 = _digits("okey", 12)
    ini_txt = F.when(cls == 9, F.concat(F.lit("31 FEB "), F.date_format("ini", "yy"))) \
        .otherwise(es_date_text("ini"))
    tariff_txt = F.when(F.col("tariff") == "DB1", F.col("tariff")) \
        .otherwise(F.concat(F.col("tariff"), F.lit("NO")))
    medidor = F.concat(F.lit("MEDIDOR: M"), F.col("ck").cast("string"))
    lines = [
        F.lit("CFE SUMINISTRADOR DE SERVICIOS BASICOS"),
        F.lit("RFC: CSS160330CP7"),
        F.concat(F.lit("CLIENTE "), F.col("ck").cast("string"), F.lit(" TOTAL A PAGAR:")),
        total,
        F.concat(F.lit("NO. DE SERVICIO: "), F.concat_ws(
            " ", F.substring(key12, 1, 3), F.substring(key12, 4, 3),
            F.substring(key12, 7, 3), F.substring(key12, 10, 3))),
        F.concat(F.lit("CUENTA: 12-AB"), _digits("ck", 8)),
        F.concat(F.lit("RMU: 29010 "), _digits("ck", 7)),
        F.concat(F.lit("RPU: ABC"), _digits("ck", 9)),
        F.concat(F.lit("LÍMITE DE PAGO: "), es_date_text(F.date_add("fin", 15))),
        F.concat(F.lit("CORTE A PARTIR: "), es_date_text(F.date_add("fin", 16))),
        F.concat(F.lit("Periodo facturado: "), ini_txt, F.lit(" - "), es_date_text("fin")),
        F.when(cls != 7, F.concat(F.lit("TARIFA: "), tariff_txt)),
        F.when(cls == 8, F.concat(medidor, F.lit(" NO HILOS: 3"))).otherwise(medidor),
        F.lit("MULTIPLICADOR: 1"),
        F.when(cls != 8, F.lit("NO HILOS: 3")),
        F.concat(F.lit("Energía (kWh) "), _fmt0(F.col("kwh") + 5000), F.lit(" "),
                 _fmt0(F.lit(5000)), F.lit(" "), _fmt0(F.col("kwh"))),
        F.lit("Cargo Fijo mensual 70.10"),
        F.concat(F.lit("Energía "), _fmt2(F.col("total"))),
        F.concat(F.lit("Subtotal "), _fmt2(F.col("total"))),
        F.lit("IVA 16% 11.22"),
        F.concat(F.lit("Fac. del Periodo "), _fmt2(F.col("total"))),
        F.concat(F.lit("Total "), _fmt2(F.col("total"))),
    ]
    return F.concat_ws("\n", *lines)


HIST_HEAD = "CONSUMO HISTÓRICO"
HIST_FOOT = "Datos Fiscales\ndel 01 ENE 25 al 02 ENE 25 1 $1 $1"
PAGE3 = "Este documento es una representación impresa de un CFDI\nTOTAL A PAGAR: $0.00"
IBERDROLA_MISSING = ("IBERDROLA MEXICO S.A. DE C.V.\n"
                     "AVISO DE COBRO SIN DESGLOSE PARA EL SERVICIO ")
PROSE = "Estimado usuario, le informamos que el documento "
PROSE_END = " no contiene datos de facturacion legibles en este momento."
WEIRD_HEAD = "CFE TARIFA CUENTA MEDIDOR RPU "


def history_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(okey, hist_text): the rendered history lines of each order, in order."""
    # Numbers are exchanged, lines are rendered behind the exchange: its tasks are even, those of a scan need not be.
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_returnflag"]
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", *order).repartition("l_orderkey")
    hs = F.date_add(F.to_date("l_shipdate"), DAY_SHIFT)
    he = F.when(F.col("l_orderkey") % 97 == 0, F.date_sub(hs, 5)) \
        .otherwise(F.date_add(hs, (29 + F.col("l_linenumber") % 3).cast("int")))
    start_txt = F.when((F.col("l_orderkey") % 100 == 9) & (F.col("l_linenumber") == 1),
                       F.concat(F.lit("31 FEB "), F.date_format(hs, "yy"))) \
        .otherwise(_line_date(hs))
    pagos = F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice")).otherwise(F.lit(0.0))
    line = F.concat(
        F.lit("del "), start_txt, F.lit(" al "), _line_date(he), F.lit(" "),
        _fmt0(F.floor(F.col("l_quantity") * 100)), F.lit(" $"),
        _fmt2(F.col("l_extendedprice")), F.lit(" $"), _fmt2(pagos))
    # Line order; rows equal on all of these render the same line. A window over
    # sorted rows: a collecting aggregate would sort its groups twice and
    # compare the rows of a group in interpreted code.
    inside = Window.partitionBy("l_orderkey").orderBy(*order)
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (li.select("l_orderkey", *order, line.alias("_line"))
            .select("l_orderkey", F.collect_list("_line").over(whole).alias("_ls"),
                    F.row_number().over(inside).alias("_row"))
            .where("_row = 1")
            .select(F.col("l_orderkey").alias("okey"), F.array_join("_ls", "\n").alias("hist_text")))


def render_bills(spark: SparkSession, sf_dir: str) -> BillSources:
    src = bill_src(spark, sf_dir)
    cls = F.col("cls")
    hist = history_lines(spark, sf_dir)

    def documents(orders: DataFrame, lines: DataFrame) -> DataFrame:
        return orders.join(lines, "okey", "left").select(
            "*",
            _file_path(cls).alias("file_path"),
            _page1(cls).alias("page1"),
            F.concat_ws("\n", F.lit(HIST_HEAD), F.col("hist_text"), F.lit(HIST_FOOT)).alias("page2"),
        )
    docs = documents(src, hist)

    iberdrola = F.concat_ws(
        "\n", F.lit("IBERDROLA CLIENTES, S.A. DE C.V."),
        F.concat(F.lit("CLIENTE "), F.col("ck").cast("string"), F.lit(" TOTAL A PAGAR:")),
        F.concat(F.lit("$"), _fmt2(F.col("total"))),
        F.lit("Categoría Tarifaria GDMTH"),
        F.concat(F.lit("Consumo "), _fmt0(F.col("kwh")), F.lit(" kWh")))
    single = (
        F.when(cls == 0, F.lit("recibo ilegible"))
        .when(cls == 2, iberdrola)
        .when(cls == 3, F.concat(F.lit(IBERDROLA_MISSING), F.col("okey").cast("string"),
                                 F.lit("\nCONSULTE SU ESTADO DE CUENTA EN LINEA")))
        .when(cls == 4, F.concat(F.lit(PROSE), F.col("okey").cast("string"), F.lit(PROSE_END)))
        .when(cls == 5, F.concat(F.lit(WEIRD_HEAD), F.repeat(F.lit("|"), PIPE_REPEAT),
                                 F.lit(" "), F.col("okey").cast("string")))
    )
    p1 = F.when(cls == 1, F.concat(F.repeat(F.lit(CID_TOKEN), CID_REPEAT), F.lit("\n"),
                                   F.col("page1"))).otherwise(F.col("page1"))
    # Embedded pages: classes 0, 2-5 have one page; class 6 has none;
    # class 15 lists page 2 before page 1 (order must not matter).
    page_rows = F.when(cls == 6, F.array()).when(
        cls.isin(0, 2, 3, 4, 5), F.array(F.struct(F.lit(1).alias("page_no"), single.alias("text")))
    ).when(cls == 15, F.array(
        F.struct(F.lit(2).alias("page_no"), F.col("page2").alias("text")),
        F.struct(F.lit(1).alias("page_no"), p1.alias("text")),
        F.struct(F.lit(3).alias("page_no"), F.lit(PAGE3).alias("text")),
    )).otherwise(F.array(
        F.struct(F.lit(1).alias("page_no"), p1.alias("text")),
        F.struct(F.lit(2).alias("page_no"), F.col("page2").alias("text")),
        F.struct(F.lit(3).alias("page_no"), F.lit(PAGE3).alias("text")),
    ))
    pages = docs.select("file_path", F.inline(page_rows))
    alt_rows = F.array(
        F.struct(F.lit(1).alias("page_no"), F.col("page1").alias("text")),
        F.struct(F.lit(2).alias("page_no"), F.col("page2").alias("text")),
        F.struct(F.lit(3).alias("page_no"), F.lit(PAGE3).alias("text")),
    )
    # The class follows from the key, so lines of other classes are left out before they are grouped.
    re_read = documents(src.where(cls.isin(*FORCED_WITH_ALTERNATE)),
                        hist.where((F.col("okey") % 100).cast("int").isin(*FORCED_WITH_ALTERNATE)))
    alternate = re_read.select("file_path", F.inline(alt_rows))

    # Listing: the bill files plus a few that a listing must leave out.
    # The path is made once a row; a row has one file or two.
    stem = F.concat(F.lit(ROOT + "/"), F.col("mall"))
    files = src.select("okey", "cls", "mall", _file_path(cls).alias("file_path"))
    extra = (
        F.when(cls == 17, F.regexp_replace("file_path", r"\.pdf$", ".xml"))
        .when(cls == 18, F.concat(stem, F.lit("/0. Contratos/" + BILLS_FOLDER + "/"),
                                  F.col("okey").cast("string"), F.lit(".pdf")))
    )
    listing = files.select(F.explode(F.array("file_path", extra)).alias("file_path")).where(F.col("file_path").isNotNull())
    return BillSources(src=src, listing=listing, pages=pages, alternate_pages=alternate)
