"""Every query with SQL against DuckDB, and property tests of predicates, joins and transactions."""

import math

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lantern import connect
from lantern.operators import aggregates, filters, joins, ordering, subqueries
from lantern.plans.catalog_queries import ORACLE, QUERIES
from lantern.sources import tables

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    duck.execute(ORACLE[name])
    own = [d[0] for d in duck.description]
    assert sorted(own) == columns
    want = [tuple(plain(r[own.index(c)]) for c in columns) for r in duck.fetchall()]
    assert sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str) == sorted(want, key=str)


ROWS = [(1, "a", None), (2, None, 3.0), (3, "b", -1.0), (None, "a", 3.0), (5, "ab%", 0.0)]
LEAF = st.one_of(
    st.tuples(st.just("i"), st.sampled_from(["=", "<>", ">", ">=", "<", "<="]), st.integers(0, 6)),
    st.tuples(st.just("s"), st.sampled_from(["=", "<>", "like"]), st.sampled_from(["a", "b", "a%", "_b%"])),
    st.tuples(st.sampled_from("isx"), st.just("null"), st.booleans()),
)
TREE = st.recursive(LEAF, lambda t: st.one_of(st.tuples(st.sampled_from(["and", "or"]), t, t), st.tuples(st.just("not"), t)), max_leaves=6)


def column(t):
    if t[0] in ("and", "or"):
        return {"and": filters.all_of, "or": filters.any_of}[t[0]](column(t[1]), column(t[2]))
    if t[0] == "not":
        return filters.negate(column(t[1]))
    return filters.is_null(t[0], t[2]) if t[1] == "null" else filters.like(t[0], t[2]) if t[1] == "like" else filters.compare(*t)


def sql(t):
    if t[0] in ("and", "or"):
        return f"(({sql(t[1])}) {t[0]} ({sql(t[2])}))"
    if t[0] == "not":
        return f"(NOT ({sql(t[1])}))"
    if t[1] == "null":
        return f"{t[0]} IS {'' if t[2] else 'NOT '}NULL"
    return f"{t[0]} {t[1]} " + (f"'{t[2]}'" if isinstance(t[2], str) else str(t[2]))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(TREE)
def test_predicates(spark, duck, tree):
    df = spark.createDataFrame(ROWS, "i int, s string, x double")
    duck.execute("CREATE OR REPLACE TABLE p (i INT, s VARCHAR, x DOUBLE)")
    duck.executemany("INSERT INTO p VALUES (?, ?, ?)", ROWS)
    got = sorted(map(str, map(tuple, df.filter(column(tree)).collect())))
    assert got == sorted(map(str, duck.execute(f"SELECT * FROM p WHERE {sql(tree)}").fetchall()))


def test_document_semantics(spark):
    df = spark.createDataFrame(ROWS, "i int, s string, x double")
    assert df.filter(filters.compare("s", "=", None, "document")).count() == 1
    assert df.filter(filters.compare("s", "<>", "a", "document")).count() == 3
    row = aggregates.global_agg(df.filter("i = 1"), {"c": ("count", "x"), "s": ("sum", "x")}, "document").first()
    assert tuple(row) == (1, 0.0)
    assert joins.equi_join(df, df.select(F.col("i").alias("k")), [("i", "k")], sem="document").count() == 5
    assert ordering.sort_page(df, ["i"], 0).count() == 0


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_scans_and_sinks(spark, tmp_path, fmt):
    rows = [(1, "a", 2.5), (2, None, -1.0), (3, "b,c", None)]
    df = spark.createDataFrame(rows, "i int, s string, x double")
    tables.sink(df, str(tmp_path), "t", fmt, by=["i"])
    own = tables.scan(spark, str(tmp_path), "t", fmt, None if fmt in tables.TYPED else "s string, x double, i int")
    assert sorted(map(tuple, own.select("i", "s", "x").collect())) == rows
    assert own.filter("i = 2").inputFiles() != [] and own.filter("i = 2").count() == 1
    if fmt not in tables.TYPED:
        with pytest.raises(ValueError):
            tables.scan(spark, str(tmp_path), "t", fmt)


def test_not_in_with_nulls(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "i int")
    ids = lambda rows: sorted(map(str, (r[0] for r in subqueries.where_in(df, "i", spark.createDataFrame(rows, "k int"), negated=True).collect())))
    assert ids([(1,)]) == ["2"] and ids([(1,), (None,)]) == [] and ids([]) == ["1", "2", "None"]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["insert", "update", "delete", "begin", "commit", "rollback"]), st.integers(0, 4), st.integers(0, 9)), max_size=8))
def test_store_follows_a_model(spark, tmp_path_factory, steps):
    db = connect(str(tmp_path_factory.mktemp("db")), spark=spark)
    cur = db.cursor()
    cur.execute("CREATE TABLE t (k INT, v INT)")
    model, saved = [], None
    for what, k, v in steps:
        if what == "insert":
            cur.execute("INSERT INTO t (k, v) VALUES (%s, %s)", (k, v))
            model = [*model, (k, v)]
        elif what == "update":
            n = cur.execute("UPDATE t SET v = %s WHERE k = %s", (v, k)).rowcount
            assert n == sum(a == k and b != v for a, b in model)
            model = [(a, v if a == k else b) for a, b in model]
        elif what == "delete":
            assert cur.execute("DELETE FROM t WHERE k = %s", (k,)).rowcount == sum(a == k for a, _ in model)
            model = [(a, b) for a, b in model if a != k]
        elif what == "begin":
            saved = saved if saved is not None else model
            db.begin()
        elif what == "commit":
            saved = None
            db.commit()
        else:
            model, saved = (saved if saved is not None else model), None
            db.rollback()
        assert sorted(cur.execute("SELECT k, v FROM t").fetchall()) == sorted(model)
