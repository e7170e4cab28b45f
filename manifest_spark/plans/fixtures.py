"""Shipping documents rendered from the star-schema tables.

One document per order: ``orders`` left-joined to ``lineitem`` grouped by
order, ``supplier``, ``customer``, ``nation`` and ``part``.  The text shape
depends on ``o_orderkey % 8`` so that every rule kind is exercised; all orders
are kept, and a line whose parts are missing is left out of the text.
The same rendering is produced by Spark (engine) and DuckDB (oracle SQL) from
one definition, so the two sides parse byte-identical text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dialect import SparkX, SqlX
from ..functions.stages import settled
from ..sources.tables import read_table
from .rules import CLOUD_CITY_CONTAINS, FIXED_CITY_RULES, SITE_NAME

#: Tasks of the text work for each core, at least.
TASKS_A_CORE = 8
ORIGIN, DESTINATION = (value for _, _, value in FIXED_CITY_RULES)


def _variants(d) -> list:
    """(condition, text) of the eight shapes."""
    c = d.col
    K = d.to_str(c("o_orderkey"))
    L = d.lpad(K, 8, "0")
    ORD = d.concat(K, d.lit("-01"))
    PO = d.to_str(c("o_custkey"))
    SUP = d.concat(d.lit("Supplier "), d.to_str(c("s_suppkey")))
    SUPN = c("s_name")
    CUS = d.concat(d.lit("Customer "), d.to_str(c("c_custkey")))
    SEG = c("c_mktsegment")
    NAT = c("n_name")
    ZIP = d.lpad(d.to_str(d.mod(c("o_custkey"), 100000)), 5, "0")
    D1 = d.fmt_dmy(c("d1"))
    D2 = d.fmt_dmy(c("d2"))
    M1 = d.fmt_mdy(c("d1"))
    W = c("weight")
    WC = d.fmt_commas(W)
    N = d.to_str(c("n_lines"))
    FC = d.fmt_commas(c("freight"))
    COMM = c("p_name")
    PRI = c("o_orderpriority")
    lit = d.lit

    v0 = d.join_lines(
        d.concat(lit("Load ID: "), L), d.concat(lit("Order: "), ORD),
        lit("Site:"), SUPN,
        lit("Address:"), d.concat(K, lit(" INDUSTRIAL DRIVE")),
        d.concat(SEG, lit(" CITY, NY "), ZIP),
        lit(ORIGIN + " 13365"),
        lit("Carrier:"), d.concat(SEG, lit(" TRUCKING")),
        lit("Ship Date:"), D1,
        d.concat(D2, lit(" 08:00")), d.concat(D1, lit(" 14:30")),
        lit("Stop"), lit("Customer & Comments"), NAT, PRI, lit("1"), lit("2"),
        d.concat(K, lit(" "), SEG, lit(" DRIVE")),
        d.concat(SEG, lit(" PARK, NJ "), ZIP),
        d.concat(SEG, lit(" INDUSTRIES")),
        lit("Roll"), N,
        d.concat(WC, lit(" lbs")),
        d.concat(lit("PO#: "), PO),
        d.concat(lit("Grade Desc: "), COMM), PRI,
        lit("Width: 48"))
    v1 = d.join_lines(
        lit("BILL OF LADING"),
        d.concat(lit("BOL Number: B"), K, lit("-"), N),
        lit("Shipper:"), SUP, d.concat(K, lit(" MAIN STREET")),
        lit("Consignee:"), CUS, d.concat(SEG, lit(" PLAZA")),
        d.concat(lit("Carrier: "), SEG, lit(" FREIGHT LINES")),
        d.concat(lit("Date Shipped: "), M1),
        d.concat(lit("Weight: "), WC),
        d.concat(lit("Pieces: "), N),
        d.concat(lit("Freight Charges: $"), FC, lit(".00")),
        d.concat(lit("Description: "), COMM),
        d.concat(lit("Reference No: R-"), K))
    v2 = d.join_lines(
        d.concat(lit("Load ID: "), L), d.concat(lit("Order: "), ORD),
        d.concat(lit("Site: "), SUPN),
        lit("Carrier:"), d.concat(SEG, lit(" LOGISTICS")),
        d.concat(D1, lit(" 06:00 ship from dock "), N),
        d.concat(lit("Total Weight: "), d.to_str(W), lit(" lbs")),
        d.concat(lit("Total Count: "), N),
        d.concat(lit("Part#: "), d.to_str(c("p_partkey")), lit(" "), COMM),
        d.concat(lit("Ref # "), K),
        d.concat(lit(f"Deliver to {CLOUD_CITY_CONTAINS[2][0]} yard "), N))
    v3 = d.join_lines(
        d.concat(lit("Load ID: "), L), d.concat(lit("Order: "), ORD),
        lit("Site:"), lit("   "),
        lit("Appt Date:"), D2,
        d.concat(lit("Appt "), D2, lit(" delivery window")),
        lit(DESTINATION + " 07045"),
        lit("Motor Carrier: Load ID pending"),
        lit("CARRIER"), d.concat(SEG, lit(" EXPRESS")),
        d.concat(lit("Contents: "), COMM),
        d.concat(lit("Units"), lit("")), lit("Qty"), lit("Weight"), N,
        lit("a"), lit("b"), lit("c"), lit("d"), lit("e"), lit("f"), lit("g"), lit("h"), N)
    v4 = d.join_lines(
        d.concat(lit("Load ID: "), L),
        d.concat(lit("Ship Date: "), M1),
        lit("SHIPPER"), SUP, d.concat(K, lit(" FIRST AVENUE")),
        lit("CONSIGNEE"), CUS, d.concat(SEG, lit(" ROAD")),
        lit("CARRIER"), d.concat(SEG, lit(" EXPRESS")),
        lit("DESCRIPTION"), COMM,
        d.concat(lit("REF "), K),
        lit("Weight"), d.to_str(W))
    v5 = d.join_lines(
        d.concat(lit("Order: "), ORD),
        d.concat(lit("Net: "), WC, lit(" pounds")),
        lit("Weight: 55 lbs"),
        lit("Pieces: 0"),
        d.concat(lit("Count: "), N),
        lit("Freight Charges: ,"),
        d.concat(lit("Total Charges: $"), FC),
        d.concat(lit("$"), FC, lit(" total due")),
        d.concat(lit("Origin: "), NAT), CUS,
        lit(SITE_NAME),
        lit("Address:"), d.concat(K, lit(" MILL ROAD")), lit(ORIGIN + " 13365"),
        d.concat(lit("Reference")))
    v6 = lit("")
    v7 = d.join_lines(
        d.concat(lit("Load ID: "), d.repeat(L, 15)),
        d.concat(lit("Order: "), ORD),
        lit("Carrier:"), d.concat(SEG, lit(" TRUCKING")),
        d.concat(D1, lit(" 10:15")),
        d.concat(WC, lit(" lbs")))
    v = d.mod(c("o_orderkey"), 8)
    return [(d.eq(v, lit(i)), t) for i, t in enumerate((v0, v1, v2, v3, v4, v5, v6, v7))]


def _tasks(spark: SparkSession) -> int:
    """Tasks of the text work: so many that a last, half-empty round of them is a small part of the time.

    Adaptive execution counts bytes, of which the narrow rows have few: its 64 MB
    are minutes of text work, and a few more tasks than cores take two rounds.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_A_CORE * spark.sparkContext.defaultParallelism)


def document_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, email_from, email_subject, attachment_name, text)`` per order."""
    t = lambda n: read_table(spark, sf_dir, n)
    li = (t("lineitem")
          .groupBy("l_orderkey")
          .agg(F.min("l_suppkey").alias("suppkey"), F.min("l_partkey").alias("partkey"),
               F.min("l_shipdate").alias("d1"), F.max("l_shipdate").alias("d2"),
               (F.sum("l_quantity").cast("bigint") * 100).alias("weight"),
               F.count(F.lit(1)).alias("n_lines")))
    base = (t("orders").join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .join(t("supplier"), F.col("s_suppkey") == F.col("suppkey"), "left")
            .join(t("customer"), F.col("c_custkey") == F.col("o_custkey"), "left")
            .join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey"), "left")
            .join(t("part"), F.col("p_partkey") == F.col("partkey"), "left")
            .withColumn("freight", F.round("o_totalprice").cast("bigint")))
    # the narrow rows are dealt evenly before the costly text work
    base = base.repartition(_tasks(spark))
    d = SparkX()
    # a compiled method for each shape: one for all would be too large for HotSpot to compile
    base = settled(base, [F.when(is_, text).alias(f"_shape{i}") for i, (is_, text) in enumerate(_variants(d))], 1)
    return base.select(
        F.col("o_orderkey").alias("doc_id"),
        F.concat(F.lit("user"), F.col("o_custkey").cast("string"), F.lit("@example.com")).alias("email_from"),
        F.concat(F.lit("Load "), F.col("o_orderkey").cast("string")).alias("email_subject"),
        F.concat(F.lit("doc_"), F.col("o_orderkey").cast("string"), F.lit(".pdf")).alias("attachment_name"),
        F.coalesce(*[f"_shape{i}" for i in range(8)]).alias("text"))


def document_text_sql() -> str:
    """DuckDB SQL producing the same rows as :func:`document_text`."""
    d = SqlX()
    return f"""
    SELECT o_orderkey AS doc_id,
           'user' || CAST(o_custkey AS VARCHAR) || '@example.com' AS email_from,
           'Load ' || CAST(o_orderkey AS VARCHAR) AS email_subject,
           'doc_' || CAST(o_orderkey AS VARCHAR) || '.pdf' AS attachment_name,
           {d.when(_variants(d))} AS text
    FROM (
      SELECT o.*, li.*, s.*, c.*, n.*, p.*,
             CAST(round(o.o_totalprice) AS BIGINT) AS freight
      FROM orders o
      LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS suppkey, min(l_partkey) AS partkey,
                   min(l_shipdate) AS d1, max(l_shipdate) AS d2,
                   CAST(sum(l_quantity) AS BIGINT) * 100 AS weight,
                   count(*) AS n_lines
            FROM lineitem GROUP BY l_orderkey) li ON o.o_orderkey = li.l_orderkey
      LEFT JOIN supplier s ON s.s_suppkey = li.suppkey
      LEFT JOIN customer c ON c.c_custkey = o.o_custkey
      LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
      LEFT JOIN part p ON p.p_partkey = li.partkey
    ) base"""
