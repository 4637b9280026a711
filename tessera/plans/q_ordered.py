"""Registered queries of the ordered operators, on NULL keys and groups, and with a value that a third of the rows share."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import expectations as X
from tessera.operators import ordered as O
from tessera.plans.catalog import register
from tessera.plans.present import present
from tessera.sources.tables import read_table


def _orders(spark, d):
    """orders with a NULL group and one price on a third of the rows (and on more where the price is missing)."""
    return read_table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("grp"),
        F.when(F.col("o_orderkey") % 3 == 0, 100000.0).when(F.col("o_orderkey") % 11 == 0, None).otherwise(F.col("o_totalprice")).alias("price"))


_ORDERS = ("(SELECT o_orderkey, o_custkey, nullif(o_orderpriority, '1-URGENT') AS grp, CASE WHEN o_orderkey % 3 = 0 THEN 100000.0 "
           "WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END::DOUBLE AS price FROM orders)")


def _quantiles(name, q, group):
    by = ", ".join(group)
    sql = (f"SELECT {by + ', ' if group else ''}round(quantile_cont(price, {q}), 6) AS quantile FROM {_ORDERS} WHERE price IS NOT NULL"
           + (f" GROUP BY {by}" if group else ""))

    @register(name, sql)
    def _(spark, d):
        return present(O.group_quantile(_orders(spark, d), "price", q, group))


_quantiles("ord_median_null_group", 0.5, ["grp"])
_quantiles("ord_quantile_by_customer", 0.3, ["o_custkey"])
_quantiles("ord_quantile_all", 0.37, [])


def _lines(spark, d):
    """lineitem with a NULL group and NULL sort keys; a third of the rows share one sort key."""
    return read_table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.nullif("l_returnflag", F.lit("N")).alias("grp"),
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(7)).when(F.col("l_orderkey") % 7 == 0, None).otherwise(F.col("l_partkey")).cast("long").alias("k"),
        F.nullif("l_quantity", F.lit(13.0)).alias("v"))


_LINES = ("(SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'N') AS grp, CASE WHEN l_orderkey % 3 = 0 THEN 7 "
          "WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_partkey END::BIGINT AS k, nullif(l_quantity, 13) AS v FROM lineitem)")
_ROW = "k NULLS LAST, l_orderkey, l_linenumber, v NULLS LAST"


@register("ord_previous_in_group",
          f"SELECT *, lag(v) OVER (PARTITION BY grp ORDER BY {_ROW}) AS prev FROM {_LINES}")
def _(spark, d):
    return O.previous_in_order(_lines(spark, d), "v", ["k", "l_orderkey", "l_linenumber"], ["grp"], "prev", num_ranges=9)


@register("ord_previous_of_all",
          f"SELECT *, lag(l_orderkey) OVER (ORDER BY {_ROW}) AS prev FROM (SELECT l_orderkey, l_linenumber, k, v FROM {_LINES})")
def _(spark, d):
    rows = _lines(spark, d).drop("grp")
    return O.previous_in_order(rows, "l_orderkey", ["k", "l_orderkey", "l_linenumber"], None, "prev", num_ranges=7)


def _monotone_sql(group, op):
    part = f"PARTITION BY {group} " if group else ""
    keep = f"{group}, " if group and op.startswith(">") else ""
    return (f"SELECT k AS sort_column, {keep}v AS value_field, lagged AS value_field_lag FROM "
            f"(SELECT *, lag(v) OVER ({part}ORDER BY k NULLS LAST, v NULLS LAST) AS lagged FROM {_LINES}) WHERE lagged IS NOT NULL AND NOT (v {op} lagged)")


@register("exp_increasing_null_group", _monotone_sql("grp", ">="))
def _(spark, d):
    return X.column_values_to_be_increasing(_lines(spark, d), "v", "k", strictly=False, group_by=["grp"])


@register("exp_decreasing_null_keys", _monotone_sql(None, "<"))
def _(spark, d):
    return X.column_values_to_be_decreasing(_lines(spark, d), "v", "k")


def _totals(name, part, descending):
    order = "k DESC NULLS FIRST" if descending else "k NULLS LAST"
    by = f"PARTITION BY {part} " if part else ""
    sql = f"SELECT *, CAST(sum(CAST(v AS BIGINT)) OVER ({by}ORDER BY {order}) AS BIGINT) AS running_total FROM {_LINES}"

    @register(name, sql)
    def _(spark, d):
        rows = _lines(spark, d).withColumn("n", F.col("v").cast("long"))
        return O.running_total(rows, "n", [part] if part else [], "k", descending, num_ranges=8).drop("n")


_totals("ord_running_total_by_flag", "grp", False)
_totals("ord_running_total_of_all", None, True)
