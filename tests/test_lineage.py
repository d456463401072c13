import pytest
from pyspark.sql import functions as F

from corpuscope.operators import lineage


def run(spark, texts, column):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, content string")
    return [r[0] for r in rows.orderBy("i").select(column).collect()]


MAIN = [
    ("unload ($$ select 1 from a $$) to 's3'", "select 1 from a"),
    ("create materialized view v as\n select * from a", "select * from a"),
    ("CREATE OR REPLACE VIEW v AS select 2", "select 2"),
    ("create view s.v as select 3", "select 3"),
    ("create temp table t as (select 4)", "select 4"),
    ("create table t as select 5", "select 5"),
    ("select 6 from x", "select 6 from x"),
    ("-- Databricks notebook source\nselect 7\n-- Databricks notebook source\n", "select 7"),
    # the table pattern has no word border and stops at the first parenthesis
    ("create table base as select * from x", "e as select * from x"),
    ("create table t as (select count(*) from x)", "select count(*"),
    ("create temporary table t as select 8", "create temporary table t as select 8"),
    ("\x1c\u00a0 select 9\u2003\n", "select 9"),
    ("", ""),
]


def test_main_query(spark):
    got = run(spark, [m[0] for m in MAIN], lineage.main_query(lineage.clean_script(F.col("content"))))
    assert got == [m[1] for m in MAIN]


def test_main_query_strict(spark):
    texts = ["create table base as select * from x", "create table t as (select count(*) from x);"]
    got = run(spark, texts, lineage.main_query(F.col("content"), strict=True))
    assert got == ["select * from x", "select count(*) from x"]


TABLES = [
    ("select * from a", ["a"]),
    ("select * from s.a x join `b`.`c` y on x.i = y.i left join d using (i)", ["s.a", "b.c", "d"]),
    ("select * from a, b as x, c y where x.i = 1", ["a", "b", "c"]),
    ("select * from (select * from a) x, b where 1 = 1", ["a", "b"]),
    ("with c as (select * from a), d(i) as (select 1 from c) select * from c join d join e", ["a", "e"]),
    ("with recursive r as (select 1 from t union all select 1 from R) select * from r", ["t"]),
    ("select 'from x', 1 -- from y\n/* from z */ from a", ["a"]),
    ("select sum(x) s, b from a", ["a"]),
    ("select f(x) y, b, g(z) w from a", ["a"]),
    ("select * from a order by f(x) desc, b limit 3", ["a"]),
    ("select extract(year from ts), trim(both 'x' from c) from a", ["a"]),
    ("select * from unnest(b) u, a", ["a"]),
    ("select * from a, unnest(b)", ["a"]),
    ("select * from a x where i in (select i from b) and exists (select 1 from a)", ["a", "b"]),
    ("select * from a union select * from b except select * from a", ["a", "b"]),
    ("insert into t (i, j) select i, j from a", ["t", "a"]),
    ("update t set i = 1 where j in (select j from a)", ["t", "a"]),
    ("delete from t where i is not distinct from 3", ["t"]),
    ('select * from "my table"', ["mytable"]),
    ("select * from a cross join b natural join c", ["a", "b", "c"]),
    ("select * from a inner join lateral (select * from b) x on true", ["a", "b"]),
    ("select from_date, joined from a", ["a"]),
    ("select 1", []),
    ("", []),
]


def test_tables(spark):
    got = run(spark, [t[0] for t in TABLES], lineage.tables(F.col("content")))
    for (text, want), found in zip(TABLES, got):
        assert found == want, text


def test_long_inputs_stay_linear(spark):
    many = "select * from " + ", ".join(f"t{i} a{i}" for i in range(20000)) + " where 1 = 1"
    literal = "select '" + "''" * 200000 + "' from a"
    got = run(spark, [many, literal], F.size(lineage.tables(F.col("content"))))
    assert got == [20000, 1]


@pytest.mark.parametrize("text, listing", [("select 1", "none"), ("select 1 from a join b", "a, b")])
def test_summary(ingest_texts, text, listing):
    docs, _ = ingest_texts({"/q.sql": f"-- Databricks notebook source\n{text}\n"})
    assert [d.page_content for d in docs] == [
        text, f"This SQL script reads from the following tables: {listing}.",
    ]
    assert docs[1].content_type == "sql_summary"


@pytest.mark.parametrize("script", ["", " -- only a note", "hello world", "select from from", "select a from", "select 1 from where x"])
def test_scripts_that_are_no_statements_have_their_text_only(ingest_texts, script):
    docs, _ = ingest_texts({"/s.sql": script})
    assert [d.kind for d in docs] == ["raw"]


@pytest.mark.parametrize("script", ["select 1", "with a as (select 1) select * from a", "(select x from t)",
                                    "select * from values (1) v", "select extract(year from d) from t"])
def test_statements_have_a_summary(ingest_texts, script):
    docs, _ = ingest_texts({"/s.sql": script})
    assert [d.kind for d in docs] == ["raw", "sql_summary"]
