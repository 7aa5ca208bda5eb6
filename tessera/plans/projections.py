"""Domain relations as projections of the test tables; each is one SQL text, which Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: name: (table, select list)
PROJECTIONS = {
    "book_move": (
        "lineitem",
        "l_orderkey AS key, l_partkey AS move, CAST(floor(l_extendedprice) AS INT) AS value, l_linenumber AS depth, "
        "CAST(l_quantity AS BIGINT) AS move_count, (l_suppkey * 100 + l_linenumber) * 1000000 + CAST(floor(l_extendedprice) AS BIGINT) AS seq, l_suppkey AS book",
    ),
    "game": (
        "orders",
        "o_orderkey AS game, o_custkey AS black, (o_custkey * 7 + 1) % 149 + 1 AS white, "
        "CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS winner, o_orderdate AS played, "
        "o_orderpriority AS opponent, CAST(floor(o_totalprice) AS BIGINT) % 3 AS nodes",
    ),
    "position_eval": (
        "lineitem",
        "l_orderkey AS game, l_linenumber * 1000000 + l_partkey AS ply, l_linenumber % 2 AS side, CAST(floor(l_extendedprice) AS BIGINT) - 30000 AS value, l_suppkey AS tie",
    ),
    "edge": (
        "lineitem",
        "l_partkey AS src, l_orderkey % 2000 + 1 AS dst, CAST(floor(l_extendedprice) AS BIGINT) AS value, (l_suppkey * 100 + l_linenumber) * 1000000 + CAST(floor(l_extendedprice) AS BIGINT) AS seq",
    ),
    "event": ("events", "event_id, ts, user_id, event_type, value"),
}


def projection(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, columns = PROJECTIONS[name]
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").selectExpr(*split_list(columns))


def sql(name: str) -> str:
    table, columns = PROJECTIONS[name]
    return f"{name} AS (SELECT {columns} FROM {table})"


def split_list(columns: str) -> list[str]:
    """The items of a select list: cut at commas outside parentheses."""
    out, depth, item = [], 0, ""
    for c in columns:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(item.strip())
            item = ""
        else:
            item += c
    return [*out, item.strip()]
