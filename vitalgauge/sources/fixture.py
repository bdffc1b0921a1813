"""Derives the input tables from the TPC-H-like test tables (see FIXTURES.md)."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgauge.operators.objects import OBJECT_KINDS
from vitalgauge.tables import Tables

#: Measures of ``solution_plan_monthly`` and the prime each is derived with.
MEASURE_PRIMES = {
    "days_edit": 2, "days_edit_hvt": 3, "days_edit_non_hvt": 5, "quarters_active": 7,
    "total_count": 11, "users_active": 13, "users_edit": 17, "users_external": 19, "users_hvt": 23,
    "users_hvt_editor": 29, "users_hvt_viewer": 31, "users_non_hvt_editor": 37,
    "users_non_hvt_viewer": 41, "users_view": 43, "days_view": 47, "days_view_hvt": 53,
    "days_view_non_hvt": 59,
}


def _month(column: str) -> Column:
    return F.trunc(F.to_date(column), "month")


def _account_of(column: str) -> Column:
    return F.expr(f"{column} div 10")


def fixture_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The ten input tables over ``<sf_dir>/*.parquet``, and two of those files as they are."""

    @functools.cache
    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def lines() -> DataFrame:
        # Both sides are large, so the join is a shuffle join at any real size. Asking for one here
        # keeps a small single-file test table from running all later steps in one task.
        return read("lineitem").join(read("orders").hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))

    def solution_monthly() -> DataFrame:
        flag, status, number = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_linenumber")
        quantity = F.col("l_quantity").cast("int")
        apps = F.when(status == "O", "Forms,WorkApps").when(flag == "A", "Forms")
        return lines().select(
            F.col("l_partkey").alias("solution_uid"),
            _month("o_orderdate").alias("date"),
            F.when(F.col("o_orderkey") % 97 != 0, F.col("o_custkey")).alias("plan_uid"),
            F.col("l_suppkey").alias("owner_uid"),
            (quantity % 6).alias("users_hvt"),
            (number - 1).alias("workflows"),
            (quantity % 10).alias("wt_complexity"),
            F.when(flag != "N", flag).alias("department"),
            (status == "O").alias("external"),
            F.when(flag != "N", flag).alias("api_integrations"),
            apps.alias("api_apps"),
            F.split(apps, ",").alias("integrations"),
            (number % 5).alias("quarters_active"),
            (quantity % 4).alias("users_active"),
            (F.col("l_partkey") % 3).alias("users_external"),
            (F.col("l_partkey") % 7).alias("users_external_view"),
        )

    def plan() -> DataFrame:
        first = read("orders").groupBy("o_custkey").agg(
            F.min(F.to_date("o_orderdate")).alias("first_paid")
        )
        return read("customer").join(first, F.col("c_custkey") == F.col("o_custkey"), "left").select(
            F.col("c_custkey").alias("plan_uid"),
            F.when(F.col("c_custkey") % 50 != 7, _account_of("c_custkey")).alias("account_id"),
            F.col("c_acctbal").cast("decimal(18,2)").alias("arr"),
            (F.col("c_custkey") % 9).alias("licenses"),
            "first_paid",
        )

    def plan_daily() -> DataFrame:
        key = F.col("plan_uid")
        grouped = read("orders").groupBy(F.col("o_custkey").alias("plan_uid"), _month("o_orderdate").alias("date"))
        return grouped.agg(
            F.count("*").alias("n"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("plan_arr"),
        ).select(
            "plan_uid",
            "date",
            (F.col("n") * 10 + key % 7).alias("users_licensed"),
            (F.col("n") * 6).alias("users_licensed_active"),
            (key % 11).alias("users_collab_internal"),
            (key % 6).alias("users_collab_internal_active"),
            (key % 5).alias("users_collab_external"),
            (key % 3).alias("users_collab_external_active"),
            (key % 9).alias("licenses"),
            "plan_arr",
        )

    def account() -> DataFrame:
        joined = read("customer").join(
            F.broadcast(read("nation")), F.col("c_nationkey") == F.col("n_nationkey")
        )
        key = F.col("account_id")
        return joined.groupBy(_account_of("c_custkey").alias("account_id")).agg(
            F.min("c_name").alias("name"),
            F.sum(F.col("c_acctbal").cast("decimal(18,2)")).alias("arr"),
            F.min("c_mktsegment").alias("segment"),
            F.min("n_name").alias("nation"),
            F.count("*").alias("n"),
        ).select(
            "account_id",
            "name",
            "arr",
            F.col("segment").alias("territory_type"),
            F.col("segment").alias("territory"),
            F.to_json(
                F.struct(F.col("segment").alias("industry"), F.col("nation").alias("subIndustry"))
            ).alias("company"),
            F.when(key % 2 == 0, F.lit("1995-01-01").cast("date")).alias("first_paid"),
            F.when(key % 3 != 0, F.lit("1995-02-01").cast("date")).alias("session_first"),
            F.col("n").alias("users_licensed_paid"),
            (F.col("n") - 1).alias("users_licensed_paid_active"),
            (F.col("n") + 2).alias("licenses_paid"),
        )

    def date_dim() -> DataFrame:
        ordered = F.to_date("o_orderdate")
        years = read("orders").agg(F.trunc(F.min(ordered), "year").alias("first"), F.trunc(F.max(ordered), "year").alias("last"))
        until = F.date_sub(F.add_months("last", 12), 1)
        days = years.select(F.explode(F.sequence("first", until)).alias("date"))
        month = F.month("date")
        return days.select(
            "date",
            F.year("date").alias("year"),
            month.alias("month_calendar"),
            F.dayofmonth("date").alias("day_of_month"),
            (F.year("date") + (month >= 2).cast("int")).alias("year_fiscal"),
        )

    def addon_plan() -> DataFrame:
        return read("supplier").select(F.col("s_nationkey").cast("bigint").alias("account_id"))

    def workapp_interval() -> DataFrame:
        start, number, kind = F.to_date("o_orderdate"), F.col("o_custkey").cast("string"), F.col("o_orderkey") % 13
        # two regions, numbers without one, and malformed and missing ids
        owner = F.when(kind == 0, F.concat(F.lit("plan.com-eu."), number)).when(kind == 1, number).when(kind == 2, "")
        owner = owner.when(kind == 3, F.concat(F.lit("plan."), number)).when(kind == 4, "plan.com-us.")
        owner = owner.when(kind == 5, F.concat(F.lit("plan.com-us."), number, F.lit(".old"))).when(kind == 6, None)
        return read("orders").select(
            (F.col("o_orderkey") % 2000).alias("container_uid"),
            start.alias("effective_from"),
            F.when(F.col("o_orderkey") % 4 != 0, F.date_add(start, 90)).alias("effective_to"),
            owner.otherwise(F.concat(F.lit("plan.com-us."), number)).alias("owner_plan_uid"),
            (F.col("o_orderkey") % 150).alias("owner_user_uid"),
            F.when(F.col("o_orderstatus") == "O", "Active").otherwise("Closed").alias("status"),
            F.lit(0).alias("changes"),
        )

    def user_plan() -> DataFrame:
        return read("events").select(F.col("user_id").alias("user_uid")).distinct().withColumn(
            "plan_uid", F.col("user_uid")
        )

    def session() -> DataFrame:
        kind = F.col("event_type")
        device = F.when(kind == "click", "Mobile iOS").when(kind == "view", "web mobile").otherwise("Desktop")
        return read("events").select(
            F.col("event_id").alias("session_uid"),
            F.col("user_id").alias("user_uid"),
            device.alias("device"),
        )

    def solution_plan_monthly() -> DataFrame:
        key = ["plan_uid", "date", "work_type"]
        source = (
            lines()
            .join(read("part"), F.col("l_partkey") == F.col("p_partkey"))
            .join(read("customer"), F.col("o_custkey") == F.col("c_custkey"))
        )
        rows = source.select(
            F.col("o_custkey").alias("plan_uid"),
            _month("o_orderdate").alias("date"),
            F.when(F.col("l_returnflag") == "N", "Not Active").otherwise(F.col("l_returnflag")).alias("work_type"),
            "l_partkey", "l_linenumber", "l_linestatus", "p_brand", "p_type", "c_mktsegment",
        )
        measures = rows.groupBy(*key).agg(
            *[F.sum(F.col("l_partkey") % prime).alias(name) for name, prime in MEASURE_PRIMES.items()]
        )

        def entry(kind: str, item: str, value: Column) -> Column:
            return F.struct(F.lit(kind).alias("kind"), F.col(item).alias("item"), value.cast("bigint").alias("value"))

        entries = rows.select(
            *key,
            F.explode(
                F.array(
                    entry("premium_apps", "p_brand", F.col("l_linenumber")),
                    entry("integrations", "p_type", F.lit(1)),
                    entry("connectors", "l_linestatus", F.lit(1)),
                    entry("assets", "c_mktsegment", F.lit(1)),
                )
            ).alias("e"),
        ).select(*key, "e.*")
        # Dealt out before they are summed: few of them are alike, so summing them ahead of the shuffle would hold nearly all
        # entries of a task in memory. Now a task gets what Spark sizes by the entries, and maps need no further shuffle.
        entries = entries.repartition(*key)
        is_asset = F.col("kind") == "assets"
        per_item = (
            entries.groupBy(*key, "kind", "item")
            .agg(F.sum("value").alias("value"))
            .withColumn("value", F.when(is_asset, F.lit(1)).otherwise(F.col("value")))
            .where(~(is_asset & (F.col("plan_uid") % 10 == 3)))
        )
        pair = F.struct("item", "value")
        maps = per_item.groupBy(*key).agg(
            *[
                F.map_from_entries(F.collect_list(F.when(F.col("kind") == kind, pair))).alias(kind)
                for kind in OBJECT_KINDS
            ]
        )
        # Each group of lines has entries, so this finds every map; as a left join on the keys of a
        # grouping, Spark drops it where no map is read.
        return measures.join(maps, key, "left").withColumn("account_id", _account_of("plan_uid"))

    derived = (
        solution_monthly, solution_plan_monthly, plan, plan_daily, account, date_dim, addon_plan,
        workapp_interval, user_plan, session,
    )
    raw = {name: functools.partial(read, name) for name in ("events", "supplier")}
    return Tables({loader.__name__: loader for loader in derived} | raw)
