"""Queries over the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlgrid.functions.money import amount, exact_sum, mean
from marlgrid.operators.aggregates import rollup_of_sums
from marlgrid.operators.joins import parents_with_children, parents_without_children
from marlgrid.operators.keysets import (
    except_all_of,
    except_of,
    intersect_all_of,
    intersect_of,
    key_set_summary,
    side_counts,
    union_of,
)
from marlgrid.operators.ranking import top_k_per_group
from marlgrid.sources.tables import read_table, units_of


def _discounted() -> Column:
    """Discounted price of a line in units of 1e-4."""
    return units_of("l_extendedprice") * (100 - units_of("l_discount"))


def _charged() -> Column:
    """Discounted price with tax in units of 1e-6."""
    return _discounted() * (100 + units_of("l_tax"))


def _lines_by_place_and_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with the order's year and the customer's nation and region.

    ``nation`` and ``region`` have a fixed size far below the broadcast threshold.
    Which way the other tables join is left to their size. In a sort-merge join
    both inputs are plain shuffles of columns cut to the needed ones, the shape in
    which adaptive execution splits a customer or order with very many rows.
    """
    places = (
        read_table(spark, sf_dir, "customer")
        .join(
            read_table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
        )
        .join(read_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "n_name", "r_name")
    )
    orders = (
        read_table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("o_year"))
        .join(places, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_year", "n_name", "r_name")
    )
    lines = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", _discounted().alias("revenue_units")
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def revenue_by_region_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discounted revenue per customer region and order year."""
    return (
        _lines_by_place_and_year(spark, sf_dir)
        .groupBy("r_name", "o_year")
        .agg(amount(exact_sum(F.col("revenue_units")), 4).alias("revenue"))
    )


def revenue_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discounted revenue per region, nation and year with all subtotals."""
    sums = {"revenue_units": exact_sum(F.col("revenue_units"))}
    return rollup_of_sums(
        _lines_by_place_and_year(spark, sf_dir), ["r_name", "n_name", "o_year"], sums
    ).select(
        "r_name", "n_name", "o_year", "level", amount(F.col("revenue_units"), 4).alias("revenue")
    )


def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line totals and means per return flag and line status, shipped by a date."""
    n = F.count("*")
    quantity = exact_sum(units_of("l_quantity"))
    price = exact_sum(units_of("l_extendedprice"))
    discount = exact_sum(units_of("l_discount"))
    shipped = F.col("l_shipdate") <= F.lit("2001-09-02").cast("timestamp_ntz")
    return (
        read_table(spark, sf_dir, "lineitem")
        .filter(shipped)
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            amount(quantity, 2).alias("sum_qty"),
            amount(price, 2).alias("sum_base_price"),
            amount(exact_sum(_discounted()), 4).alias("sum_disc_price"),
            amount(exact_sum(_charged()), 6).alias("sum_charge"),
            mean(quantity, 2, n).alias("avg_qty"),
            mean(price, 2, n).alias("avg_price"),
            mean(discount, 2, n).alias("avg_disc"),
            n.alias("count_order"),
        )
    )


def orders_without_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that no line refers to."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )
    return parents_without_children(
        orders, read_table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey"
    )


def _in_quarter(date: str) -> Column:
    """Whether a date lies in the first quarter of 1996."""
    first, end = (F.lit(day).cast("timestamp_ntz") for day in ("1996-01-01", "1996-04-01"))
    return (F.col(date) >= first) & (F.col(date) < end)


def customers_with_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with at least one finished order of the first quarter of 1996."""
    orders = read_table(spark, sf_dir, "orders").filter(
        (F.col("o_orderstatus") == "F") & _in_quarter("o_orderdate")
    )
    customers = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_mktsegment"
    )
    return parents_with_children(customers, orders, "c_custkey", "o_custkey")


def top_customers_per_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten customers of each segment with the highest order total."""
    spending = (
        read_table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(exact_sum(units_of("o_totalprice")).alias("spent"))
    )
    customers = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    spent = spending.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    order = [F.col("spent").desc(), F.col("c_custkey")]
    return top_k_per_group(spent, ["c_mktsegment"], order, 10).select(
        "c_mktsegment", "rank", "c_custkey", amount(F.col("spent"), 2).alias("total_spent")
    )


def _part_counts(spark: SparkSession, sf_dir: str, lines: Column | None = None) -> DataFrame:
    """Returned and accepted lines per part, among ``lines`` or all: one scan, one shuffle."""
    flag = F.col("l_returnflag")
    chosen = read_table(spark, sf_dir, "lineitem").filter(flag.isin("R", "A"))
    if lines is not None:
        chosen = chosen.filter(lines)
    return side_counts(
        chosen.withColumnRenamed("l_partkey", "partkey"), "partkey", flag == "R", flag == "A"
    )


def parts_returned_or_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts on a returned or an accepted line shipped in the quarter: ``UNION``."""
    return union_of(_part_counts(spark, sf_dir, _in_quarter("l_shipdate")), "partkey")


def parts_returned_and_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts on a returned and on an accepted line shipped in the quarter: ``INTERSECT``."""
    return intersect_of(_part_counts(spark, sf_dir, _in_quarter("l_shipdate")), "partkey")


def parts_returned_not_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts on a returned but no accepted line shipped in the quarter: ``EXCEPT``."""
    return except_of(_part_counts(spark, sf_dir, _in_quarter("l_shipdate")), "partkey")


def parts_returned_like_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many returned lines of a part have an accepted one: ``INTERSECT ALL``."""
    return intersect_all_of(_part_counts(spark, sf_dir, _in_quarter("l_shipdate")), "partkey")


def parts_returned_beyond_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many more returned than accepted lines a part has: ``EXCEPT ALL``."""
    return except_all_of(_part_counts(spark, sf_dir), "partkey")


def part_set_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts in the catalogue against parts on returned lines shipped in the quarter."""
    catalogue = read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("partkey"))
    returned = (
        read_table(spark, sf_dir, "lineitem")
        .filter((F.col("l_returnflag") == "R") & _in_quarter("l_shipdate"))
        .select(F.col("l_partkey").alias("partkey"))
    )
    return key_set_summary(catalogue, returned, "partkey")
