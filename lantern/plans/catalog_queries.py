"""Queries by inventory item, each with DuckDB's SQL for the same result.

Sums of money are exact decimals before they become doubles, so no result depends on the order of rows.
"""

from __future__ import annotations

import asyncio
import logging
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lantern import dbapi
from lantern.aio import connect_async
from lantern.dbapi import connect
from lantern.errors import LanternError
from lantern.operators import aggregates as agg
from lantern.operators import filters as f
from lantern.operators import joins as j
from lantern.operators import ordering as o
from lantern.operators import setops as u
from lantern.operators import subqueries as q
from lantern.operators import windows as w
from lantern.session import shared_dir
from lantern.sources.tables import scan

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
ORDERS = ("o_orderkey", "o_custkey", "o_totalprice")


def query(sql: str):
    """Registers a query under its function's name; it gets a function from table names to DataFrames."""

    def register(fn):
        QUERIES[fn.__name__] = lambda spark, folder: fn(lambda name: scan(spark, folder, name))
        ORACLE[fn.__name__] = sql
        return fn

    return register


def money(col: str) -> Column:
    return F.col(col).cast("decimal(18,2)")


def total(col: str) -> Column:
    return F.sum(money(col)).cast("double")


def mean(col: str) -> Column:
    return F.round(F.sum(money(col)).cast("double") / F.count(col), 6)


_TOTAL = "CAST(sum(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)"
_MEAN = "round(CAST(sum(CAST({0} AS DECIMAL(18,2))) AS DOUBLE) / count({0}), 6)"


@query(f"""SELECT c_mktsegment, count(*) AS n_orders, {_TOTAL.format('o_totalprice')} AS total, {_MEAN.format('o_totalprice')} AS mean
FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 1000 GROUP BY c_mktsegment HAVING count(*) > 10""")
def order_summary(t):
    big = t("orders").filter(f.compare("o_totalprice", ">", 1000))
    both = j.equi_join(big, t("customer"), [("o_custkey", "c_custkey")])
    out = agg.group_agg(both, ["c_mktsegment"], {"n_orders": ("count",), "total": total("o_totalprice"), "mean": mean("o_totalprice")}, F.col("n_orders") > 10)
    return o.sort_page(out, ["c_mktsegment"])


# projections


@query("SELECT o_orderkey, o_custkey AS cust FROM orders")
def scan_project(t):
    return t("orders").select("o_orderkey", F.col("o_custkey").alias("cust"))


@query("SELECT n_name, n_nationkey, n_regionkey FROM nation")
def scan_star_sorted(t):
    return t("nation").select(*sorted(t("nation").columns))


@query("SELECT n.n_name, n.n_nationkey * 2 + 1 AS odd, upper(n.n_name) AS up, 1 AS one FROM nation n")
def project_expressions(t):
    return t("nation").alias("n").select("n.n_name", (F.col("n.n_nationkey") * 2 + 1).alias("odd"), F.upper("n.n_name").alias("up"), F.lit(1).alias("one"))


@query("SELECT r_regionkey AS a, r_name AS b FROM region")
def project_nested_path(t):
    return t("region").select(F.struct(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name")).alias("r")).select(F.col("r.key").alias("a"), F.col("r.name").alias("b"))


@query("SELECT DISTINCT p_brand, p_type FROM part")
def distinct(t):
    return t("part").select("p_brand", "p_type").distinct()


# predicates


def _orders(sql_condition: str):
    return query(f"SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE {sql_condition}")


@_orders("o_orderstatus = 'F'")
def filter_eq(t):
    return t("orders").filter(f.compare("o_orderstatus", "=", "F")).select(*ORDERS)


@_orders("o_orderstatus <> 'F'")
def filter_neq(t):
    return t("orders").filter(f.compare("o_orderstatus", "<>", "F")).select(*ORDERS)


@_orders("o_totalprice > 1000 AND o_totalprice <= 300000 AND o_orderkey >= 10 AND o_custkey < 500")
def filter_range_gt_ge_lt_le(t):
    return t("orders").filter(f.all_of(f.compare("o_totalprice", ">", 1000), f.compare("o_totalprice", "<=", 300000), f.compare("o_orderkey", ">=", 10), f.compare("o_custkey", "<", 500))).select(*ORDERS)


@query("SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE (c_mktsegment = 'BUILDING' OR c_acctbal > 5000) AND c_nationkey < 10")
def filter_and_or_paren(t):
    either = f.any_of(f.compare("c_mktsegment", "=", "BUILDING"), f.compare("c_acctbal", ">", 5000))
    return t("customer").filter(f.all_of(either, f.compare("c_nationkey", "<", 10))).select("c_custkey", "c_mktsegment", "c_acctbal")


@query("SELECT p_partkey, p_size FROM part WHERE p_size BETWEEN 5 AND 15")
def filter_between(t):
    return t("part").filter(f.between("p_size", 5, 15)).select("p_partkey", "p_size")


@query("SELECT p_partkey, p_size FROM part WHERE p_size IN (1, 7, 49)")
def filter_in_list(t):
    return t("part").filter(f.in_list("p_size", [1, 7, 49])).select("p_partkey", "p_size")


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%an_il%'")
def filter_like(t):
    return t("part").filter(f.like("p_name", "%an_il%")).select("p_partkey", "p_name")


@query("SELECT p_partkey, p_name FROM part WHERE p_name ILIKE 'B%'")
def filter_ilike(t):
    return t("part").filter(f.ilike("p_name", "B%")).select("p_partkey", "p_name")


@query("SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^b.*[aeiou]')")
def filter_regex(t):
    return t("part").filter(f.regex("p_name", "/^b.*[aeiou]/")).select("p_partkey", "p_name")


@query("SELECT d.doc_id, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS DISTINCT FROM 1")
def filter_neq_document_nulls(t):
    return _labelled(t).filter(f.compare("quality", "<>", 1, "document")).select("doc_id", "quality")


def _labelled(t) -> DataFrame:
    labels = t("labels").withColumnRenamed("doc_id", "l_doc_id")
    return j.equi_join(t("documents").select("doc_id", "lang", "source"), labels, [("doc_id", "l_doc_id")], "left")


@query("SELECT d.doc_id, lang FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE (quality IS NULL AND lang NOT IN ('en', 'fr')) OR (quality IS NOT NULL AND NOT (source LIKE 'src1%'))")
def filter_not_null_family(t):
    none = f.all_of(f.is_null("quality"), f.negate(f.in_list("lang", ["en", "fr"])))
    some = f.all_of(f.is_null("quality", False), f.negate(f.like("source", "src1%")))
    return _labelled(t).filter(f.any_of(none, some)).select("doc_id", "lang")


@query("SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem WHERE l_discount > l_tax")
def filter_column_vs_column(t):
    return t("lineitem").filter(f.compare("l_discount", ">", F.col("l_tax"))).select("l_orderkey", "l_linenumber", "l_discount", "l_tax")


@query("SELECT o_orderkey FROM orders WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders)")
def filter_scalar_subquery(t):
    top = t("orders").agg(F.max("o_totalprice").alias("top"))
    return t("orders").join(top, F.col("o_totalprice") == F.col("top"), "left_semi").select("o_orderkey")


# joins


@query("SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 5000")
def join_inner(t):
    return j.equi_join(t("orders"), t("customer"), [("o_custkey", "c_custkey")]).filter("c_acctbal > 5000").select("o_orderkey", "c_name")


@query("SELECT d.doc_id, lang, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def join_left(t):
    return _labelled(t).select("doc_id", "lang", "quality", "toxic")


@query("SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def join_two_hop(t):
    return j.chain_join(t("customer"), [(t("nation"), [("c_nationkey", "n_nationkey")]), (t("region"), [("n_regionkey", "r_regionkey")])]).select("c_custkey", "n_name", "r_name")


@query("""SELECT o_orderkey, r_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey = 2""")
def join_three_hop(t):
    hops = [(t("customer"), [("o_custkey", "c_custkey")]), (t("nation"), [("c_nationkey", "n_nationkey")]), (t("region"), [("n_regionkey", "r_regionkey")])]
    return j.chain_join(t("orders"), hops).filter("r_regionkey = 2").select("o_orderkey", "r_name")


@query("SELECT a.n_name AS left_name, b.n_name AS right_name FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey WHERE a.n_nationkey < b.n_nationkey")
def join_self(t):
    a, b = (t("nation").select([F.col(c).alias(f"{x}_{c}") for c in t("nation").columns]) for x in "ab")
    return j.equi_join(a, b, [("a_n_regionkey", "b_n_regionkey")]).filter("a_n_nationkey < b_n_nationkey").select(F.col("a_n_name").alias("left_name"), F.col("b_n_name").alias("right_name"))


@query("""SELECT a.conv_id, a.turn, b.role AS next_role FROM conversations a
JOIN (SELECT conv_id AS c, turn - 1 AS before, role FROM conversations) b ON a.conv_id = b.c AND a.turn = b.before""")
def join_composite_key(t):
    later = t("conversations").select(F.col("conv_id").alias("c"), (F.col("turn") - 1).alias("before"), F.col("role").alias("next_role"))
    return j.equi_join(t("conversations"), later, [("conv_id", "c"), ("turn", "before")]).select("conv_id", "turn", "next_role")


@query("""SELECT a.x, a.n, b.m FROM (SELECT nullif(quality, 0) AS x, count(*) AS n FROM labels GROUP BY 1) a
JOIN (SELECT nullif(quality, 0) AS y, count(DISTINCT toxic) AS m FROM labels GROUP BY 1) b ON a.x IS NOT DISTINCT FROM b.y""")
def join_null_safe(t):
    x = F.expr("nullif(quality, 0)")
    a = t("labels").groupBy(x.alias("x")).agg(F.count(F.lit(1)).alias("n"))
    b = t("labels").groupBy(x.alias("y")).agg(F.countDistinct("toxic").alias("m"))
    return j.equi_join(a, b, [("x", "y")], sem="document").select("x", "n", "m")


@query("SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey ORDER BY c_name DESC, o_orderkey LIMIT 20 OFFSET 5")
def join_order_limit_offset(t):
    both = j.equi_join(t("orders"), t("customer"), [("o_custkey", "c_custkey")]).select("o_orderkey", "c_name")
    return o.sort_page(both, [F.desc("c_name"), "o_orderkey"], 20, 5)


@query(f"SELECT n_name, {_TOTAL.format('o_totalprice')} AS revenue, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def join_group(t):
    both = j.chain_join(t("orders"), [(t("customer"), [("o_custkey", "c_custkey")]), (t("nation"), [("c_nationkey", "n_nationkey")])])
    return agg.group_agg(both, ["n_name"], {"revenue": total("o_totalprice"), "n": ("count",)})


def _outer(t, how: str) -> DataFrame:
    """Sizes over 24 are no nation's key, and key 0 is no part's size, so either side has rows without a match."""
    return j.equi_join(t("part"), t("nation"), [("p_size", "n_nationkey")], how).select("p_partkey", "p_size", "n_nationkey", "n_name")


_OUTER = "SELECT p_partkey, p_size, n_nationkey, n_name FROM part {} JOIN nation ON p_size = n_nationkey"


@query(_OUTER.format("RIGHT"))
def join_right(t):
    return _outer(t, "right")


@query(_OUTER.format("FULL"))
def join_full(t):
    return _outer(t, "full")


@query("SELECT a.r_name AS low, b.n_name AS high FROM region a JOIN nation b ON a.r_regionkey > b.n_nationkey")
def join_theta(t):
    return j.theta_join(t("region"), t("nation"), F.col("r_regionkey") > F.col("n_nationkey")).select(F.col("r_name").alias("low"), F.col("n_name").alias("high"))


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def join_semi(t):
    return j.equi_join(t("documents"), t("labels").select(F.col("doc_id").alias("k")), [("doc_id", "k")], "left_semi").select("doc_id", "lang")


@query("SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def join_anti(t):
    return j.equi_join(t("documents"), t("labels").select(F.col("doc_id").alias("k")), [("doc_id", "k")], "left_anti").select("doc_id", "lang")


@query("SELECT a.r_name AS x, b.r_name AS y FROM region a CROSS JOIN region b")
def join_cross(t):
    return j.cross_join(t("region").select(F.col("r_name").alias("x")), t("region").select(F.col("r_name").alias("y")))


@query("SELECT n_name, r_name FROM nation JOIN (SELECT r_regionkey AS n_regionkey, r_name FROM region) USING (n_regionkey)")
def join_using(t):
    return t("nation").join(t("region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey").select("n_name", "r_name")


# aggregation


@query(f"""SELECT l_returnflag, l_linestatus, count(*) AS n, {_TOTAL.format('l_quantity')} AS qty, {_MEAN.format('l_extendedprice')} AS mean_price,
min(l_shipdate) AS first_ship, max(l_extendedprice) AS top FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def group_count_sum_avg_min_max(t):
    return agg.group_agg(t("lineitem"), ["l_returnflag", "l_linestatus"], {"n": ("count",), "qty": total("l_quantity"), "mean_price": mean("l_extendedprice"), "first_ship": ("min", "l_shipdate"), "top": ("max", "l_extendedprice")})


@query("SELECT lang, count(*) AS n_rows, count(quality) AS n_labels, CAST(coalesce(sum(quality), 0) AS BIGINT) AS good FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY lang")
def count_col_vs_star(t):
    return agg.group_agg(_labelled(t), ["lang"], {"n_rows": ("count",), "n_labels": ("count", "quality"), "good": F.coalesce(F.sum("quality"), F.lit(0)).cast("bigint")})


@query("SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY o_orderpriority")
def count_distinct(t):
    return agg.group_agg(t("orders"), ["o_orderpriority"], {"customers": ("count_distinct", "o_custkey")})


@query(f"SELECT count(*) AS n, {_TOTAL.format('o_totalprice')} AS total, min(o_orderdate) AS first, max(o_orderdate) AS last FROM orders")
def global_agg(t):
    return agg.global_agg(t("orders"), {"n": ("count",), "total": total("o_totalprice"), "first": ("min", "o_orderdate"), "last": ("max", "o_orderdate")})


@query("SELECT count(*) AS n FROM orders WHERE o_orderkey < 0 HAVING count(*) > 0")
def global_agg_document_empty(t):
    return agg.global_agg(t("orders").filter("o_orderkey < 0"), {"n": ("count",)}, sem="document")


@query("SELECT o_custkey, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 2 WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS score FROM orders GROUP BY o_custkey")
def sum_case(t):
    return agg.group_agg(t("orders"), ["o_custkey"], {"score": agg.sum_case([(F.col("o_orderstatus") == "F", 2), (F.col("o_orderstatus") == "O", 1)])})


@query(f"SELECT o_custkey, {_TOTAL.format('o_totalprice')} AS total FROM orders GROUP BY o_custkey HAVING sum(CAST(o_totalprice AS DECIMAL(18,2))) > 1000000")
def having_alias(t):
    return agg.group_agg(t("orders"), ["o_custkey"], {"total": total("o_totalprice")}, F.col("total") > 1000000)


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING max(o_totalprice) >= 400000")
def having_expr(t):
    return agg.group_agg(t("orders"), ["o_custkey"], {"n": ("count",), "top": ("max", "o_totalprice")}, F.col("top") >= 400000).drop("top")


@query("SELECT n_nationkey, min(n_name) AS n_name, count(*) AS n FROM nation JOIN customer ON n_nationkey = c_nationkey GROUP BY n_nationkey")
def group_first_value(t):
    both = j.equi_join(t("customer"), t("nation"), [("c_nationkey", "n_nationkey")])
    return agg.group_agg(both, ["n_nationkey"], {"n_name": ("first", "n_name"), "n": ("count",)})


@query(f"SELECT o_custkey, {_TOTAL.format('o_totalprice')} AS spent FROM orders GROUP BY o_custkey ORDER BY spent DESC, o_custkey LIMIT 10 OFFSET 3")
def group_order_limit_offset(t):
    return o.sort_page(agg.group_agg(t("orders"), ["o_custkey"], {"spent": total("o_totalprice")}), [F.desc("spent"), "o_custkey"], 10, 3)


@query("SELECT count(*) AS n, max(n_orders) AS most FROM (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey)")
def agg_from_subquery(t):
    return agg.global_agg(agg.group_agg(t("orders"), ["o_custkey"], {"n_orders": ("count",)}), {"n": ("count",), "most": ("max", "n_orders")})


@query("SELECT n_orders, count(*) AS customers FROM (SELECT o_custkey, count(*) AS n_orders FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey) GROUP BY n_orders")
def group_from_subquery(t):
    inner = agg.group_agg(t("orders").filter("o_orderstatus = 'F'"), ["o_custkey"], {"n_orders": ("count",)})
    return agg.group_agg(inner, ["n_orders"], {"customers": ("count",)})


@query("SELECT l_returnflag, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(1 - l_discount AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM lineitem GROUP BY l_returnflag")
def agg_of_expression(t):
    net = money("l_extendedprice") * (1 - F.col("l_discount")).cast("decimal(18,2)")
    return agg.group_agg(t("lineitem"), ["l_returnflag"], {"revenue": F.sum(net).cast("double")})


# windows


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders")
def window_row_number(t):
    return w.rank_window(t("orders"), "row_number", [F.desc("o_totalprice"), "o_orderkey"], ["o_custkey"], "rn").select("o_orderkey", "rn")


@query("SELECT p_partkey, rank() OVER (PARTITION BY p_brand ORDER BY p_size) AS r FROM part")
def window_rank(t):
    return w.rank_window(t("part"), "rank", ["p_size"], ["p_brand"], "r").select("p_partkey", "r")


@query("SELECT p_partkey, dense_rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS r FROM part")
def window_dense_rank(t):
    return w.rank_window(t("part"), "dense_rank", [F.desc("p_size")], ["p_brand"], "r").select("p_partkey", "r")


@query("SELECT n_nationkey, row_number() OVER (ORDER BY n_regionkey, n_nationkey) AS rn FROM nation")
def window_no_partition(t):
    return w.rank_window(t("nation"), "row_number", ["n_regionkey", "n_nationkey"], alias="rn").select("n_nationkey", "rn")


@query("SELECT event_id, rank() OVER (PARTITION BY user_id, event_type ORDER BY ts) AS r FROM events")
def window_multi_partition(t):
    return w.rank_window(t("events"), "rank", ["ts"], ["user_id", "event_type"], "r").select("event_id", "r")


@query("""SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) AS rn, rank() OVER (PARTITION BY p_brand ORDER BY p_size) AS r,
dense_rank() OVER (PARTITION BY p_brand ORDER BY p_size) AS d FROM part WHERE p_size > 10""")
def window_multi(t):
    df = w.rank_window(t("part").filter("p_size > 10"), "row_number", ["p_size", "p_partkey"], ["p_brand"], "rn")
    return w.rank_window(w.rank_window(df, "rank", ["p_size"], ["p_brand"], "r"), "dense_rank", ["p_size"], ["p_brand"], "d").select("p_partkey", "rn", "r", "d")


@query("SELECT * FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 3")
def window_topn_per_group(t):
    return w.top_n_per_group(t("orders"), ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"], 3).select("o_custkey", "o_orderkey", "rn")


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders WHERE o_orderstatus = 'F'")
def window_filtered(t):
    return w.rank_window(t("orders").filter("o_orderstatus = 'F'"), "row_number", ["o_orderkey"], ["o_custkey"], "rn").select("o_orderkey", "rn")


@query("SELECT o_orderkey, lag(o_orderkey) OVER k AS before, lead(o_orderkey, 2) OVER k AS after FROM orders WINDOW k AS (PARTITION BY o_custkey ORDER BY o_orderkey)")
def window_lag_lead(t):
    df = w.neighbour(t("orders").select("o_custkey", "o_orderkey"), "o_orderkey", ["o_orderkey"], ["o_custkey"], 1, "before")
    return w.neighbour(df, "o_orderkey", ["o_orderkey"], ["o_custkey"], -2, "after").drop("o_custkey")


@query("""SELECT p_partkey, CAST(sum(p_size) OVER (PARTITION BY p_brand ORDER BY p_partkey ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS BIGINT) AS near,
CAST(sum(p_size) OVER (PARTITION BY p_brand ORDER BY p_partkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS so_far FROM part""")
def window_frames(t):
    df = w.framed(t("part").select("p_partkey", "p_brand", "p_size"), F.sum("p_size"), ["p_partkey"], ["p_brand"], 2, 1, "near")
    return w.framed(df, F.sum("p_size"), ["p_partkey"], ["p_brand"], alias="so_far").select("p_partkey", "near", "so_far")


@query("SELECT c_custkey, ntile(4) OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) AS tile FROM customer")
def window_ntile(t):
    return w.tiles(t("customer"), 4, ["c_acctbal", "c_custkey"], ["c_nationkey"]).select("c_custkey", "tile")


@query("SELECT p_partkey, CAST(count(*) OVER (PARTITION BY p_brand ORDER BY p_size RANGE BETWEEN 5 PRECEDING AND 3 FOLLOWING) AS BIGINT) AS like_size FROM part")
def window_range_frame(t):
    return w.ranged(t("part"), F.count(F.lit(1)), "p_size", 5, 3, ["p_brand"], "like_size").select("p_partkey", "like_size")


# order and pages


@query("SELECT o_orderkey, o_orderpriority FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 50")
def sort_multi(t):
    return o.sort_page(t("orders"), ["o_orderpriority", F.desc("o_totalprice"), "o_orderkey"], 50).select("o_orderkey", "o_orderpriority")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def topk(t):
    return o.sort_page(t("orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), "o_orderkey"], 10)


@query("SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 10 OFFSET 25")
def limit_offset(t):
    return o.sort_page(t("orders").select("o_orderkey"), ["o_orderkey"], 10, 25)


@query("SELECT d.doc_id, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id ORDER BY quality DESC NULLS LAST, d.doc_id LIMIT 30")
def sort_nulls(t):
    return o.sort_page(_labelled(t).select("doc_id", "quality"), [F.desc_nulls_last("quality"), "doc_id"], 30)


# set operations


def _keys(t, table: str, col: str, bound: int | None = None) -> DataFrame:
    df = t(table).select(F.col(col).cast("bigint").alias("k"))
    return df if bound is None else df.filter(F.col("k") < bound)


_C, _S, _N = "SELECT CAST(c_nationkey AS BIGINT) AS k FROM customer", "SELECT CAST(s_nationkey AS BIGINT) FROM supplier WHERE s_nationkey < 12", "SELECT CAST(n_nationkey AS BIGINT) FROM nation"


@query(f"{_C} UNION ALL {_S}")
def union_all(t):
    return u.union_all(_keys(t, "customer", "c_nationkey"), _keys(t, "supplier", "s_nationkey", 12))


@query(f"SELECT k FROM ({_C} UNION ALL {_S}) ORDER BY k DESC LIMIT 15 OFFSET 2")
def union_all_order_limit(t):
    return o.sort_page(u.union_all(_keys(t, "customer", "c_nationkey"), _keys(t, "supplier", "s_nationkey", 12)), [F.desc("k")], 15, 2)


@query(f"{_C} UNION ALL {_S} UNION ALL {_N}")
def union_all_three(t):
    return u.union_all(_keys(t, "customer", "c_nationkey"), _keys(t, "supplier", "s_nationkey", 12), _keys(t, "nation", "n_nationkey"))


@query(f"{_C} UNION {_S}")
def union_distinct(t):
    return u.union_distinct(_keys(t, "customer", "c_nationkey"), _keys(t, "supplier", "s_nationkey", 12))


@query(f"{_C} INTERSECT {_S}")
def intersect(t):
    return u.intersect(_keys(t, "customer", "c_nationkey"), _keys(t, "supplier", "s_nationkey", 12))


@query(f"{_C} EXCEPT {_S}")
def except_distinct(t):
    return u.except_(_keys(t, "customer", "c_nationkey"), _keys(t, "supplier", "s_nationkey", 12))


# subqueries


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 8000)")
def in_subquery(t):
    return q.where_in(t("orders"), "o_custkey", t("customer").filter("c_acctbal > 8000").select("c_custkey")).select("o_orderkey")


@query("SELECT d.doc_id FROM documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def not_in_subquery(t):
    return q.where_in(t("documents"), "doc_id", t("labels").select("doc_id"), negated=True).select("doc_id")


@query("SELECT r_name FROM region WHERE EXISTS (SELECT 1 FROM orders WHERE o_totalprice > 100) AND NOT EXISTS (SELECT 1 FROM orders WHERE o_totalprice < 0)")
def exists_gate(t):
    some = q.where_exists(t("region"), t("orders").filter("o_totalprice > 100"))
    return q.where_exists(some, t("orders").filter("o_totalprice < 0"), negated=True).select("r_name")


@query("SELECT name FROM (SELECT c_name AS name, c_acctbal AS bal FROM customer WHERE c_nationkey < 5) WHERE bal > 0")
def from_subquery(t):
    return t("customer").filter("c_nationkey < 5").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal")).filter("bal > 0").select("name")


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1))")
def nested_subquery(t):
    inner = q.where_in(t("customer"), "c_nationkey", t("nation").filter("n_regionkey = 1").select("n_nationkey"))
    return q.where_in(t("orders"), "o_custkey", inner.select("c_custkey")).select("o_orderkey")


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)")
def correlated_exists(t):
    return q.where_exists_on(t("customer"), t("orders").filter("o_totalprice > 450000"), [("c_custkey", "o_custkey")]).select("c_custkey")


def _db(spark: SparkSession, folder: str, *names: str):
    """A connection to a store of its own that sees the named tables."""
    db = connect(f"{shared_dir(spark)}/store-{uuid.uuid4().hex}", "main", spark=spark)
    for name in names:
        scan(db.spark, folder, name).createOrReplaceTempView(name)
    return db


def sql_query(name: str, statements: list, oracle: str, *tables: str) -> None:
    """A query through the DB-API surface: the last statement's result. statements: SQL or (SQL, parameters)."""

    def run(spark, folder):
        cur = _db(spark, folder, *tables).cursor()
        for s in statements:
            s() if callable(s) else getattr(cur.connection, s[1:])() if s[0] == "!" else cur.execute(*([s] if isinstance(s, str) else s))
        return cur.dataframe

    QUERIES[name], ORACLE[name] = run, oracle


_CTE = "WITH big AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_totalprice > 200000 GROUP BY o_custkey) SELECT c_name, n FROM big JOIN customer ON k = c_custkey"
sql_query("cte", [_CTE], _CTE, "orders", "customer")
sql_query("bind_positional", [("SELECT o_orderkey FROM orders WHERE o_custkey = %s AND o_orderstatus <> %s ORDER BY o_orderkey LIMIT %s", (7, "F", 5))], "SELECT o_orderkey FROM orders WHERE o_custkey = 7 AND o_orderstatus <> 'F' ORDER BY o_orderkey LIMIT 5", "orders")
sql_query("bind_named", [("SELECT o_orderkey FROM orders WHERE o_custkey = %(c)s OR o_orderkey = %(c)s", {"c": 7})], "SELECT o_orderkey FROM orders WHERE o_custkey = 7 OR o_orderkey = 7", "orders")
sql_query("sql_group_names", ["SELECT r_regionkey, COUNT(*), SUM(n_nationkey) FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_regionkey"], "SELECT r_regionkey, count(*) AS count, CAST(sum(n_nationkey) AS BIGINT) AS sum_n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_regionkey", "nation", "region")
_COPY = ["CREATE TABLE n (n_nationkey INT, n_name VARCHAR(50), n_regionkey INT)", "INSERT INTO n (n_nationkey, n_name, n_regionkey) SELECT n_nationkey, n_name, n_regionkey FROM nation"]
_ALL = "SELECT n_nationkey, n_name, n_regionkey FROM n"
sql_query("dml_insert", [*_COPY, ("INSERT INTO n (n_nationkey, n_name, n_regionkey) VALUES (%s, %s, %s)", (99, "NEW", 1)), _ALL], "SELECT * FROM nation UNION ALL SELECT 99, 'NEW', 1", "nation")
sql_query("dml_update", [*_COPY, ("UPDATE n SET n_name = %s, n_regionkey = n_regionkey + 1 WHERE n_regionkey = %s", ("X", 1)), _ALL], "SELECT n_nationkey, CASE WHEN n_regionkey = 1 THEN 'X' ELSE n_name END AS n_name, CASE WHEN n_regionkey = 1 THEN 2 ELSE n_regionkey END AS n_regionkey FROM nation", "nation")
sql_query("dml_delete", [*_COPY, "DELETE FROM n WHERE n_regionkey IN (1, 2)", _ALL], "SELECT * FROM nation WHERE n_regionkey NOT IN (1, 2)", "nation")
sql_query("txn_rollback", [*_COPY, "!begin", "DELETE FROM n WHERE n_regionkey = 1", "!rollback", _ALL], "SELECT * FROM nation", "nation")
sql_query("txn_commit", [*_COPY, "!begin", "DELETE FROM n WHERE n_regionkey = 1", "INSERT INTO n (n_nationkey) VALUES (77)", "!commit", _ALL], "SELECT * FROM nation WHERE n_regionkey <> 1 UNION ALL SELECT 77, NULL, NULL", "nation")
_DERIVED = "SELECT c_name, n FROM customer JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) x ON x.o_custkey = c_custkey WHERE n > 3"
sql_query("join_derived_table", [_DERIVED], _DERIVED, "customer", "orders")
sql_query("union_all_offset", ["SELECT n_nationkey AS k FROM nation UNION ALL SELECT r_regionkey FROM region ORDER BY k DESC LIMIT 7 OFFSET 4"], "SELECT n_nationkey AS k FROM nation UNION ALL SELECT r_regionkey FROM region ORDER BY k DESC LIMIT 7 OFFSET 4", "nation", "region")
sql_query("dml_update_scalar_subquery", [*_COPY, "UPDATE n SET n_regionkey = (SELECT max(r_regionkey) FROM region) WHERE n_nationkey < 5", _ALL], "SELECT n_nationkey, n_name, CASE WHEN n_nationkey < 5 THEN (SELECT max(r_regionkey) FROM region) ELSE n_regionkey END AS n_regionkey FROM nation", "nation", "region")
sql_query("dml_insert_many_rows", [*_COPY, "INSERT INTO n (n_nationkey, n_name, n_regionkey) VALUES (90, 'A', 1), (91, NULL, 2)", _ALL], "SELECT * FROM nation UNION ALL SELECT 90, 'A', 1 UNION ALL SELECT 91, NULL, 2", "nation")


# the same inventory through SQL text


def sql_same(name: str, sql: str, *tables: str) -> None:
    """A SELECT that DuckDB takes as it stands."""
    sql_query(name, [sql], sql, *tables)


sql_query("sql_regexp_slashes", ["SELECT p_partkey, p_name FROM part WHERE p_name REGEXP '/^blue/'"], "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^blue')", "part")
sql_query("sql_regexp_parameter", [("SELECT p_partkey, p_name FROM part WHERE p_name RLIKE %(p)s AND p_name <> %(p)s", {"p": "/l$/"})], "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, 'l$')", "part")
sql_same("sql_star", "SELECT * FROM nation", "nation")
sql_same("sql_bare_boolean", "SELECT c_custkey FROM (SELECT c_custkey, c_acctbal > 5000 AS rich FROM customer) x WHERE rich AND 3 < c_custkey", "customer")
sql_same("sql_join_on_either_side", "SELECT c_custkey, n_name FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA'", "customer", "nation", "region")
sql_same("sql_join_natural", "SELECT n_name, r_name FROM nation NATURAL JOIN (SELECT r_regionkey AS n_regionkey, r_name FROM region) r", "nation", "region")
sql_same("sql_join_comma", "SELECT n_name, r_name FROM nation, region WHERE n_regionkey = r_regionkey", "nation", "region")
sql_same("sql_window_outer_order", "SELECT * FROM (SELECT c_custkey, rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS r FROM customer) x ORDER BY r, c_custkey LIMIT 30 OFFSET 5", "customer")
sql_same("sql_window_join", "SELECT c_custkey, n_name, row_number() OVER (PARTITION BY n_name ORDER BY c_custkey) AS rn FROM customer JOIN nation ON c_nationkey = n_nationkey", "customer", "nation")
sql_same("sql_window_group", "SELECT c_nationkey, count(*) AS n, rank() OVER (ORDER BY count(*) DESC, c_nationkey) AS r FROM customer GROUP BY c_nationkey", "customer")
sql_same("sql_window_subquery", "SELECT k, n, dense_rank() OVER (ORDER BY n DESC) AS r FROM (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY o_custkey) x WHERE k IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)", "orders", "customer")
sql_same("sql_order_ordinal", "SELECT o_custkey, o_orderkey FROM orders ORDER BY 1 DESC, o_orderkey % 7, 2 LIMIT 40", "orders")
sql_same("sql_order_of_subquery", "SELECT k FROM (SELECT o_orderkey AS k FROM orders ORDER BY k LIMIT 100) x WHERE k % 3 = 1", "orders")
sql_same("sql_page_of_subquery", "SELECT k FROM (SELECT o_orderkey AS k FROM orders ORDER BY k DESC LIMIT 50 OFFSET 10) x ORDER BY k LIMIT 20 OFFSET 4", "orders")
sql_same("sql_union_subquery_branch", "SELECT n_nationkey AS k FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_regionkey > 2) UNION ALL SELECT r_regionkey FROM (SELECT * FROM region) x", "nation", "region")
sql_same("sql_rollup", "SELECT n_regionkey, count(*) AS n FROM nation GROUP BY ROLLUP (n_regionkey)", "nation")
sql_same("sql_grouping_sets", "SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY GROUPING SETS ((c_mktsegment), (c_nationkey), ())", "customer")
sql_same("sql_group_items", "SELECT n_regionkey + 1 AS k, 'x' AS s, max(n_name) AS top, count(*) * 2 AS twice FROM nation GROUP BY n_regionkey", "nation")
sql_query("sql_group_first_value", ["SELECT n_nationkey, n_name, COUNT(*) AS n FROM nation JOIN customer ON n_nationkey = c_nationkey GROUP BY n_nationkey HAVING n > 2"], "SELECT n_nationkey, min(n_name) AS n_name, count(*) AS n FROM nation JOIN customer ON n_nationkey = c_nationkey GROUP BY n_nationkey HAVING count(*) > 2", "nation", "customer")
sql_query("sql_aggregate_names", ["SELECT n_regionkey, COUNT(*), COUNT(*), COUNT(n_name), COUNT(DISTINCT n_name), MAX(n_nationkey) FROM nation GROUP BY n_regionkey"], "SELECT n_regionkey, count(*) AS count, count(*) AS count_2, count(n_name) AS count_n_name, count(DISTINCT n_name) AS count_distinct_n_name, max(n_nationkey) AS max_n_nationkey FROM nation GROUP BY n_regionkey", "nation")
sql_query("dml_insert_no_columns", [*_COPY, "INSERT INTO n VALUES (98, 'LAST', 4)", _ALL], "SELECT * FROM nation UNION ALL SELECT 98, 'LAST', 4", "nation")
sql_query("dml_insert_subquery_value", [*_COPY, "INSERT INTO n (n_nationkey, n_name) VALUES ((SELECT max(n_nationkey) + 1 FROM nation), 'NEXT'), (97, (SELECT min(r_name) FROM region))", _ALL], "SELECT * FROM nation UNION ALL SELECT max(n_nationkey) + 1, 'NEXT', NULL FROM nation UNION ALL SELECT 97, min(r_name), NULL FROM region", "nation", "region")
sql_query("dml_drop_table", [*_COPY, "DROP TABLE n", *_COPY, _ALL], "SELECT * FROM nation", "nation")
sql_query("ddl_indexes", [*_COPY, "CREATE UNIQUE INDEX ix ON n (n_nationkey DESC)", "CREATE INDEX n ON n (n_name)", "DROP INDEX n", "DROP INDEX ix ON n", "INSERT INTO n (n_nationkey) VALUES (1)", _ALL], "SELECT * FROM nation UNION ALL SELECT 1, NULL, NULL", "nation")
sql_query("ddl_create_as", ["CREATE TABLE big AS SELECT o_custkey AS k, COUNT(*) FROM orders GROUP BY o_custkey", "SELECT k, count FROM big WHERE count > 5"], "SELECT o_custkey AS k, count(*) AS count FROM orders GROUP BY o_custkey HAVING count(*) > 5", "orders")
sql_query("ddl_view", [*_COPY, "CREATE VIEW low AS SELECT n_nationkey FROM n WHERE n_regionkey < 2", "INSERT INTO n (n_nationkey, n_regionkey) VALUES (55, 0)", "SELECT n_nationkey FROM low"], "SELECT n_nationkey FROM nation WHERE n_regionkey < 2 UNION ALL SELECT 55", "nation")


def _registered(name: str, oracle: str):
    def register(fn):
        QUERIES[name], ORACLE[name] = fn, oracle
        return fn

    return register


@_registered("sql_nested_path", "SELECT n_nationkey AS inner_k, n_name FROM nation WHERE n_nationkey > 3")
def _nested_path(spark, folder):
    """"s.k" is a path; the result's column has that name, without the dot here."""
    db = _db(spark, folder, "nation")
    db.spark.sql("SELECT named_struct('k', n_nationkey) AS s, n_name FROM nation").createOrReplaceTempView("nested")
    return db.cursor().execute('SELECT "s.k", n_name FROM nested WHERE "s.k" > 3').dataframe.withColumnRenamed("s.k", "inner_k")


@_registered("sql_window_no_alias", "SELECT c_custkey, rank() OVER (ORDER BY c_custkey) AS r FROM customer WHERE c_nationkey = 3")
def _window_no_alias(spark, folder):
    """The window's column has a name of Spark's own."""
    return _db(spark, folder, "customer").cursor().execute("SELECT c_custkey, rank() OVER (ORDER BY c_custkey) FROM customer WHERE c_nationkey = 3").dataframe.toDF("c_custkey", "r")


@_registered("sql_join_star", "SELECT n_name, n_nationkey, n_regionkey, r_name AS __join1_r_name, r_regionkey AS __join1_r_regionkey FROM nation JOIN region ON n_regionkey = r_regionkey")
def _join_star(spark, folder):
    df = _db(spark, folder, "nation", "region").cursor().execute("SELECT * FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey").dataframe
    return df.toDF(*[c.replace(".", "_") for c in df.columns])


@_registered("executemany", "SELECT r_regionkey AS k, r_name AS s FROM region")
def _executemany(spark, folder):
    rows = [(r["r_regionkey"], r["r_name"]) for r in scan(spark, folder, "region").collect()]  # five
    cur = _db(spark, folder).cursor()
    cur.executemany("INSERT INTO t (k, s) VALUES (%s, %s)", rows)
    return cur.execute("SELECT k, s FROM t").dataframe


@_registered("list_tables", "SELECT * FROM (VALUES ('a', true), ('b', false), ('nation', true)) x(name, there)")
def _list_tables(spark, folder):
    db = _db(spark, folder, "nation")
    for name in "ab":
        db.cursor().execute(f"CREATE TABLE {name} (k INT)")
    db.cursor().execute("DROP TABLE b")
    return spark.createDataFrame([(n, db.has_table(n)) for n in sorted({*db.list_tables(), "b"})], "name string, there boolean")


#: Statement, parameters, code and whether the strict profile is needed.
_REJECTED = [
    ("no where", "DELETE FROM n", None, "E3", False), ("literal true", "DELETE FROM n WHERE true", None, "E3", False), ("always true", "UPDATE n SET n_name = 'x' WHERE 1 = 1", None, "E3", False),
    ("true parameter", "DELETE FROM n WHERE %s", (True,), "E3", False), ("row of two", "INSERT INTO n (n_nationkey) VALUES (1, 2)", None, "E4", False), ("too few", "SELECT n_name FROM n WHERE n_nationkey = %s", (), "E4", False),
    ("having", "SELECT n_regionkey, count(*) AS c FROM n GROUP BY n_regionkey HAVING n_name > 'x'", None, "E2", False), ("rank without order", "SELECT rank() OVER (PARTITION BY n_name) AS r FROM n", None, "E2", False),
    ("merge", "MERGE INTO n USING n AS s ON n.n_nationkey = s.n_nationkey WHEN MATCHED THEN DELETE", None, "E2", False), ("syntax", "SELCT 1", None, "E5", False), ("no table", "UPDATE nothing SET a = 1 WHERE a = 2", None, "E5", False),
    ("full join", "SELECT a.n_name FROM n a FULL JOIN n b ON a.n_name = b.n_name", None, "E2", True), ("theta join", "SELECT a.n_name FROM n a JOIN n b ON a.n_name > b.n_name", None, "E2", True), ("union", "SELECT n_name FROM n UNION SELECT n_name FROM n", None, "E2", True),
]


@_registered("rejected_statements", "SELECT * FROM (VALUES " + ", ".join(f"('{what}', '{code}')" for what, _, _, code, _ in _REJECTED) + ") x(what, code)")
def _rejected(spark, folder):
    db, rows = _db(spark, folder, "nation"), []
    for s in _COPY:
        db.cursor().execute(s)
    for what, sql, params, _, strict in _REJECTED:
        db.profile = "strict" if strict else "extended"
        try:
            db.cursor().execute(sql, params)
            rows.append((what, "none"))
        except LanternError as e:
            rows.append((what, e.code))
    return spark.createDataFrame(rows, "what string, code string")


_SURFACE = """WITH n AS (SELECT *, row_number() OVER (ORDER BY n_nationkey) AS i FROM nation),
names AS (SELECT string_agg(n_name, ',' ORDER BY i) FILTER (i = 1) AS one, string_agg(n_name, ',' ORDER BY i) FILTER (i IN (2, 3)) AS two, string_agg(n_name, ',' ORDER BY i) FILTER (i > 3) AS rest, count(*) AS n FROM n)
SELECT what, value FROM names, LATERAL (VALUES ('apilevel', '2.0'), ('threadsafety', '1'), ('paramstyle', 'pyformat'), ('fetchone', one), ('fetchmany', two), ('fetchall', rest), ('after the end', 'None'),
    ('description', 'n_nationkey,n_name'), ('rowcount', CAST(n AS VARCHAR)), ('iteration', concat(one, ',', two, ',', rest)), ('closed cursor', 'E5'), ('empty path', 'E1'), ('percent in a string', '1'),
    ('async rows', two), ('async rowcount', '2'), ('async transaction', 'rolled back'), ('logged', 'begin,execute,rollback')) x(what, value)"""


@_registered("dbapi_surface", _SURFACE)
def _surface(spark, folder):
    """What clients see of module, connection and cursor, blocking and async, as rows."""
    db, rows = _db(spark, folder, "nation"), [("apilevel", dbapi.apilevel), ("threadsafety", str(dbapi.threadsafety)), ("paramstyle", dbapi.paramstyle)]
    by_key = "SELECT n_nationkey, n_name FROM nation ORDER BY n_nationkey"
    names = lambda got: ",".join(r[-1] for r in got)
    cur = db.cursor().execute(by_key)
    rows += [("fetchone", names([cur.fetchone()])), ("fetchmany", names(cur.fetchmany(2))), ("fetchall", names(cur.fetchall())), ("after the end", str(cur.fetchone()))]
    rows += [("description", ",".join(d[0] for d in cur.description)), ("rowcount", str(db.cursor().execute(by_key).rowcount)), ("iteration", names(db.cursor().execute(by_key)))]
    rows.append(("percent in a string", str(db.cursor().execute("SELECT 1 AS n WHERE '%s' <> '%(a)s' -- %s").fetchone()[0])))
    cur.close()
    for what, call in (("closed cursor", lambda: cur.execute(by_key)), ("empty path", lambda: connect("", spark=spark))):
        try:
            call()
        except LanternError as e:
            rows.append((what, e.code))

    async def other() -> list:
        async with await connect_async(f"{shared_dir(spark)}/store-{uuid.uuid4().hex}", "main", spark=spark) as own:
            cur = await own.cursor()
            await cur.execute("CREATE TABLE t (k INT, s STRING)")
            await cur.executemany("INSERT INTO t (k, s) VALUES (%s, %s)", [tuple(r) for r in two])
            out = [("async rowcount", str(cur.rowcount))]
            await own.begin()
            await cur.execute("DELETE FROM t WHERE k >= 0")
            await own.rollback()
            got = [r async for r in await cur.execute("SELECT k, s FROM t ORDER BY k")]
            return [*out, ("async rows", names(got)), ("async transaction", "rolled back" if got else "lost")]

    two = db.cursor().execute(by_key + " LIMIT 2 OFFSET 1").fetchall()
    rows += asyncio.run(other())
    seen: list[str] = []
    watch = logging.Handler()
    watch.emit = lambda record: seen.append(record.getMessage().split()[0])
    level = dbapi.log.level
    dbapi.log.addHandler(watch)
    dbapi.log.setLevel(logging.DEBUG)
    try:
        db.begin()
        db.cursor().execute(by_key)
        db.rollback()
    finally:
        dbapi.log.removeHandler(watch)
        dbapi.log.setLevel(level)
    return spark.createDataFrame([*rows, ("logged", ",".join(seen))], "what string, value string")
