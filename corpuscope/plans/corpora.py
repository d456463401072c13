"""Repositories rendered as text from relational tables.

The tables hold no YAML, JSON, SQL or Python files, so the text is generated
from them. Every function reads whole tables and returns ``path, content``.
Groups that form one file are bounded: a file takes at most about
``LINES_PER_FILE`` rows, whatever the distribution of the keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuscope.session import materialize, materialize_for_join
from corpuscope.sources.tables import partitions_for, read_spread, read_table

LINES_PER_FILE = 1000
MOST_LONG_ORDERS = 1_000_000
CUSTOMERS_PER_FILE = 1000
ORDERS_PER_FILE = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows become whole files, parsed in Python afterwards."""
    return read_spread(spark, f"{sf_dir}/{name}.parquet")


def text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per document; five extensions in turn."""
    suffixes = F.array(*[F.lit(s) for s in (".yaml", ".json", ".sql", ".py", ".md")])
    suffix = F.get(suffixes, F.pmod(F.col("doc_id"), F.lit(5)).cast("int"))
    path = F.concat(F.lit("/repo/"), "source", F.lit("/"), F.col("doc_id").cast("string"), suffix)
    return spread_table(spark, sf_dir, "documents").select(path.alias("path"), F.col("text").alias("content"))


def _orders_with_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``o_orderkey, file_no, o, lines`` with the lines in a total order.

    Almost every order fits into one file. Only orders above the limit are
    counted out, and their lines are dealt over several files. Orders and lines
    are not joined but united and grouped, so each line is shuffled once and no
    key gathers more than about one file's worth of rows.
    """
    lines = table(spark, sf_dir, "lineitem")
    # Long orders are few, mostly none: computed once, and only then joined.
    long_orders = materialize_for_join(
        lines.groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.floor(F.count("*") / LINES_PER_FILE).alias("more_files"))
        .where(F.col("more_files") > 0),
        MOST_LONG_ORDERS,
    )
    no_long_orders = long_orders.isEmpty()

    def with_more_files(df: DataFrame) -> DataFrame:
        if no_long_orders:
            return df.withColumn("more_files", F.lit(0).cast("long"))
        joined = df.join(long_orders, "o_orderkey", "left")
        return joined.withColumn("more_files", F.coalesce("more_files", F.lit(0).cast("long")))

    more_files = F.col("more_files")
    line = F.struct(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate",
        "l_returnflag", "l_linestatus",
    )
    line_rows = with_more_files(lines.withColumnRenamed("l_orderkey", "o_orderkey")).select(
        "o_orderkey", F.pmod(F.col("l_partkey"), 1 + more_files).alias("file_no"),
        line.alias("line"),
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = table(spark, sf_dir, "orders")
    owned = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    order_rows = with_more_files(owned).select(
        "o_orderkey", F.explode(F.sequence(F.lit(0).cast("long"), more_files)).alias("file_no"),
        F.struct("o_custkey", "o_orderpriority", "c_name", (more_files == 0).alias("short"))
        .alias("o"),
    )
    n = partitions_for(lines, orders)
    grouped = (
        line_rows.unionByName(order_rows, allowMissingColumns=True)
        .repartition(n, "o_orderkey", "file_no")
        .groupBy("o_orderkey", "file_no")
        .agg(
            F.first("o", ignorenulls=True).alias("o"),
            F.sort_array(F.collect_list("line")).alias("lines"),
        )
    )
    return grouped.where(F.col("o.short") | (F.size("lines") > 0))


def _quoted(value: Column) -> Column:
    return F.concat(F.lit('"'), value, F.lit('"'))


def _order_workflow(lines: Column) -> Column:
    """YAML of one order; tasks are its lines, run in one chain."""

    def task(line: Column, i: Column) -> Column:
        script = F.when(
            line["l_linestatus"] != "O",
            F.concat(F.lit('\n    file: "part_'), line["l_partkey"].cast("string"), F.lit('.py"')),
        ).otherwise(F.lit(""))
        return F.concat(
            F.lit('  "line_'), (i + 1).cast("string"), F.lit('":\n    operator: '),
            _quoted(line["l_returnflag"]), script, F.lit("\n"),
        )

    names = F.transform(lines, lambda _, i: F.concat(F.lit("line_"), (i + 1).cast("string")))
    body = F.concat(
        F.lit("tasks:\n"), F.array_join(F.transform(lines, task), ""),
        F.lit("execution:\n  - "), _quoted(F.array_join(names, " >> ")), F.lit("\n"),
    )
    return F.concat(
        F.lit("dag:\n  dag_id: "),
        _quoted(F.concat(F.lit("order_"), F.col("o_orderkey").cast("string"))),
        F.lit("\n  schedule_interval: "),
        _quoted(F.concat(F.lit("0 5 * * "), F.pmod(F.col("o.o_custkey"), F.lit(7)).cast("string"))),
        F.lit("\n  description: "), _quoted(F.col("o.o_orderpriority")),
        F.lit("\n  default_args:\n    owner: "), _quoted(F.col("o.c_name")), F.lit("\n"),
        F.when(F.size(lines) > 0, body).otherwise(F.lit("tasks: {}\n")),
    )


def _numbered(prefix: str, key: Column, file_no: Column) -> Column:
    return F.concat(
        F.lit(prefix), key.cast("string"), F.lit("_"), file_no.cast("string"), F.lit(".yaml")
    )


def stored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their lines, computed once for several kinds of files."""
    return materialize(_orders_with_lines(spark, sf_dir))


def workflow_files(
    spark: SparkSession, sf_dir: str, orders: DataFrame | None = None
) -> DataFrame:
    """One workflow file per order; ``orders`` are those of ``stored_orders``."""
    rows = _orders_with_lines(spark, sf_dir) if orders is None else orders
    return rows.select(
        _numbered("/dags/order_", F.col("o_orderkey"), F.col("file_no")).alias("path"),
        _order_workflow(F.col("lines")).alias("content"),
    )


def faulty_workflow_files(
    spark: SparkSession, sf_dir: str, orders: DataFrame | None = None
) -> DataFrame:
    """Several orders per file; those divisible by seven have no task mapping."""
    rows = _orders_with_lines(spark, sf_dir) if orders is None else orders
    n = partitions_for(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))
    broken = F.concat(
        F.lit('dag:\n  dag_id: "order_'), F.col("o_orderkey").cast("string"), F.lit('"\ntasks:\n')
    )
    content = F.when(F.pmod("o_orderkey", F.lit(7)) == 0, broken).otherwise(
        _order_workflow(F.col("lines"))
    )
    return (
        rows.select(
            F.floor(F.col("o_orderkey") / ORDERS_PER_FILE).alias("batch"),
            "file_no", "o_orderkey", content.alias("content"),
        )
        .repartition(n, "batch", "file_no")
        .groupBy("batch", "file_no")
        .agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "content"))).alias("parts"))
        .select(
            _numbered("/dags/batch_", F.col("batch"), F.col("file_no")).alias("path"),
            F.array_join(F.col("parts.content"), "---\n").alias("content"),
        )
    )


def workflow_shape_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One workflow per supplier: a fork and join, nothing given, nulls given, and an execution
    that is no list, in turn."""
    key = F.col("s_suppkey")
    fork = F.format_string(
        "dag:\n  dag_id: s_%s\n  schedule_interval: '@daily'\n  description: fork\n"
        "  default_args: {owner: own_%s}\n"
        "tasks:\n  a: {operator: o, file: f.py}\n  b: {operator: o}\n  c: {file: c.py}\n  d: {}\n"
        "execution:\n  - a >> b >> d\n  - a >>c>> d\n",
        key, F.col("s_nationkey"),
    )
    nulls = F.lit(
        "dag: {dag_id: null, schedule_interval: ~, description: , default_args: {owner: null}}\n"
        "tasks: {t: {operator: null, file: null}}\n"
    )
    text = F.format_string(
        "dag: {dag_id: s_%s}\ntasks: {a: {}, b: {}}\nexecution: a >> b\n", key
    )
    content = (
        F.when(key % 4 == 0, fork)
        .when(key % 4 == 1, F.lit("dag: {}\ntasks: {t: {}}\n"))
        .when(key % 4 == 2, nulls)
        .otherwise(text)
    )
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("/shapes/"), key.cast("string"), F.lit(".yaml")).alias("path"),
        content.alias("content"),
    )


def settings_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file of settings per supplier; a line of some has no value."""
    key = F.col("s_suppkey")
    broken = F.when(key % 7 == 0, F.lit("[late]\nwithout value\n[never]\nx = 1\n")).otherwise(F.lit(""))
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("/settings/"), key.cast("string"), F.lit(".ini")).alias("path"),
        F.concat(
            F.lit("; settings\n[supplier]\nname = "), "s_name", F.lit("\nnation="),
            F.col("s_nationkey").cast("string"), F.lit("\n\n[level "), (key % 3).cast("string"),
            F.lit("]\ndepth = 1\n"), broken,
        ).alias("content"),
    )


def nested_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One workflow per supplier with lists of ten aliases each, up to six levels of them, or
    brackets in brackets."""
    level = F.pmod(F.col("s_suppkey"), F.lit(8)).cast("int")
    name = lambda k: F.concat(F.lit("x"), k.cast("string"))

    def line(k: Column) -> Column:
        item = F.when(k == 0, F.lit("lol")).otherwise(F.concat(F.lit("*"), name(k - 1)))
        return F.concat(
            name(k), F.lit(": &"), name(k), F.lit(" ["),
            F.array_join(F.array_repeat(item, 10), ", "), F.lit("]\n"),
        )

    aliases = F.array_join(F.transform(F.sequence(F.lit(0), level), line), "")
    brackets = F.concat(F.lit("deep: "), F.repeat(F.lit("["), 3000), F.repeat(F.lit("]"), 3000), F.lit("\n"))
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("/nested/"), F.col("s_suppkey").cast("string"), F.lit(".yaml")).alias("path"),
        F.concat(
            F.when(level == 7, brackets).otherwise(aliases),
            F.lit("dag:\n  dag_id: "), _quoted(F.col("s_name")), F.lit("\n"),
        ).alias("content"),
    )


def dictionary_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dictionary per nation and block of customer keys; columns are customers
    in descending key order."""
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    key = F.col("c_custkey")
    description = (
        F.when(F.pmod(key, F.lit(7)) == 0, F.lit('"is_metric": false'))
        .when(F.pmod(key, F.lit(5)) == 0, F.lit('"description": null'))
        .otherwise(F.concat(F.lit('"description": '), _quoted(F.col("c_mktsegment"))))
    )
    traits = F.when(
        F.pmod(key, F.lit(3)) == 0,
        F.lit('"column_type": "string", "max_length": "25", '
              '"pii_confidentiality_impact_level": "low", '),
    ).otherwise(F.lit('"pii_confidentiality_impact_level": null, '))
    column = F.concat(
        F.lit("    "), _quoted(F.col("c_name")), F.lit(": {"), traits, description, F.lit("}")
    )
    blocks = (
        table(spark, sf_dir, "customer")
        .groupBy("c_nationkey", F.floor(key / CUSTOMERS_PER_FILE).alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct(key, column.alias("text"))), False).alias("cols"))
    )
    return blocks.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(
            F.lit("/dict/"), "n_name", F.lit("_"), F.col("block").cast("string"), F.lit(".json")
        ).alias("path"),
        F.concat(
            F.lit('{\n  "schema": '), _quoted(F.col("r_name")), F.lit(',\n  "table": '),
            _quoted(F.col("n_name")), F.lit(',\n  "column_types": {\n'),
            F.array_join(F.col("cols.text"), ",\n"),
            F.lit('\n  },\n  "table_id": ["id", "block"],\n  "source": ['),
            _quoted(F.concat(F.lit("lake."), F.lower("n_name"))), F.lit("]\n}\n"),
        ).alias("content"),
    )


def sql_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One script per part; wrappers, CTEs and notebook markers in turn."""
    key = F.col("p_partkey")
    first = F.concat(
        F.lit("brand_"), F.regexp_extract("p_brand", r"(\d+)", 1), F.lit(".size_"),
        F.col("p_size").cast("string"),
    )
    second = F.concat(F.lit("types."), F.lower("p_type"))
    query = F.when(
        key % 3 == 0,
        F.concat(
            F.lit("with c as (select * from "), first, F.lit(") select * from c join "), second
        ),
    ).otherwise(F.concat(F.lit("select 1 from "), first, F.lit(" x join "), second, F.lit(" y")))
    name = F.concat(F.lit("t_"), key.cast("string"))
    wrapped = (
        F.when(key % 5 == 0, F.concat(F.lit("unload ($$ "), query, F.lit(" $$) to 's3://out'")))
        .when(
            key % 5 == 1,
            F.concat(F.lit("create materialized view "), name, F.lit("\nas\n"), query),
        )
        .when(
            key % 5 == 2, F.concat(F.lit("CREATE OR REPLACE VIEW "), name, F.lit(" AS "), query)
        )
        .when(
            key % 10 == 3, F.concat(F.lit("create temp table "), name, F.lit(" as ("), query, F.lit(")"))
        )
        .when(key % 5 == 3, F.concat(F.lit("create table "), name, F.lit(" as "), query))
        .otherwise(query)
    )
    marker = F.when(key % 2 == 0, F.lit("-- Databricks notebook source\n")).otherwise(F.lit(""))
    return spread_table(spark, sf_dir, "part").select(
        F.concat(F.lit("/sql/"), key.cast("string"), F.lit(".sql")).alias("path"),
        F.concat(marker, wrapped, F.lit("\n")).alias("content"),
    )


def sql_shape_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One script per part with comments, literals, lists of tables and several common table
    expressions in turn."""
    key = F.col("p_partkey")
    first = F.concat(F.lit("lake.part_"), key.cast("string"))
    second = F.concat(F.lit("types."), F.lower("p_type"))
    shape = lambda text: F.format_string(text, first, second)
    content = (
        F.when(key % 6 == 0, shape("-- from ignored.one\nselect 1 from %1$s a, %2$s b\n"))
        .when(
            key % 6 == 1,
            shape("select 'from no.where' as t from %1$s x /* join no.where */ join %2$s y on x.a = y.a"),
        )
        .when(
            key % 6 == 2,
            shape(
                "with a as (select * from %1$s), b as (\n  select * from a join %2$s on true)\n"
                "select * from b join a on true"
            ),
        )
        .when(key % 6 == 3, shape("select * from (select * from %1$s) x, %2$s y"))
        .when(key % 6 == 4, shape("insert into %2$s select * from %1$s"))
        .otherwise(shape("select extract(day from d) from %1$s where x = 'it''s from %2$s'"))
    )
    return spread_table(spark, sf_dir, "part").select(
        F.concat(F.lit("/shapes/"), key.cast("string"), F.lit(".sql")).alias("path"),
        content.alias("content"),
    )


def python_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One script per part; async functions, missing docstrings, syntax errors."""
    key, size = F.col("p_partkey"), F.col("p_size")

    def number(c: Column) -> Column:
        return c.cast("string")

    docstring = F.when(key % 4 == 0, F.lit("    pass\n")).otherwise(
        F.concat(F.lit('    """'), "p_name", F.lit('"""\n'))
    )
    keyword = F.when(key % 6 == 0, F.lit("async def f_")).otherwise(F.lit("def f_"))
    broken = F.when(key % 11 == 0, F.lit("def (:\n")).otherwise(F.lit(""))
    return spread_table(spark, sf_dir, "part").select(
        F.concat(F.lit("/py/"), number(key), F.lit(".py")).alias("path"),
        F.concat(
            F.lit("import lib_"), number(size % 7), F.lit(", lib_"), number(size % 5),
            F.lit(".sub\nfrom pkg_"), number(size % 3), F.lit(" import x\nfrom . import y\n\n\n"),
            keyword, number(key), F.lit("():\n"), docstring, broken,
        ).alias("content"),
    )
