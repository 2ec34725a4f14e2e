"""Revenue aggregates, from daily totals to the long metric table behind the dashboards."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revenuelake import constants as C
from revenuelake.functions.dates import in_period, month_slot, month_start, months_before, quarter_start
from revenuelake.functions.ratios import pct_change, ratio
from revenuelake.operators.staging import stg_payments

def _day() -> Column:
    return F.col("payment_date")


def _totals(amount: str) -> list[Column]:
    return [F.sum("amount").alias(amount), F.countDistinct("taxpayer_id").alias("unique_taxpayers")]


def taxpayer_totals(payments: DataFrame, *keys: Column | str) -> DataFrame:
    """Sums per taxpayer and ``keys``: a busy taxpayer shrinks to a few rows before any join.

    ``amount`` is the sum, ``payments`` counts rows and ``amounts`` counts known amounts.
    """
    return payments.groupBy("taxpayer_id", *keys).agg(
        F.sum("amount").alias("amount"),
        F.count(F.lit(1)).alias("payments"),
        F.count("amount").alias("amounts"),
    )


def revenue_daily(payments: DataFrame) -> DataFrame:
    return stg_payments(payments).groupBy("payment_date", "tax_type", "payment_channel").agg(
        *_totals("daily_amount"), F.count(F.lit(1)).alias("transaction_count")
    )


def revenue_monthly(payments: DataFrame) -> DataFrame:
    return stg_payments(payments).groupBy(month_start(_day()).alias("revenue_month"), "tax_type").agg(
        *_totals("monthly_amount"),
        F.count(F.lit(1)).alias("transaction_count"),
        ratio(F.sum("amount"), F.count("amount")).alias("avg_payment_amount"),
    )


def revenue_regional(payments: DataFrame, taxpayers: DataFrame) -> DataFrame:
    per_taxpayer = taxpayer_totals(stg_payments(payments), month_start(_day()).alias("revenue_month"), "tax_type")
    return (
        per_taxpayer.join(taxpayers.select("taxpayer_id", "region", "district"), "taxpayer_id")
        .groupBy("region", "district", "tax_type", "revenue_month")
        .agg(*_totals("amount"))
    )


def revenue_sector(payments: DataFrame, taxpayers: DataFrame) -> DataFrame:
    per_taxpayer = taxpayer_totals(stg_payments(payments), quarter_start(_day()).alias("revenue_quarter"), "tax_type")
    sectors = taxpayers.filter(F.col("business_sector").isNotNull()).select(
        "taxpayer_id", "business_sector", "business_subsector"
    )
    return (
        per_taxpayer.join(sectors, "taxpayer_id")
        .groupBy("business_sector", "business_subsector", "tax_type", "revenue_quarter")
        .agg(*_totals("amount"), ratio(F.sum("amount"), F.sum("amounts")).alias("avg_payment"))
    )


def revenue_aggregations(payments: DataFrame, taxpayers: DataFrame) -> DataFrame:
    """Daily, monthly, regional and sector totals in one long table.

    The daily level needs no taxpayer columns and reads the payments once. The other three come from one
    monthly pre-aggregation per taxpayer, joined once and grouped with grouping sets.
    """
    columns = [
        "aggregation_level", "period_date", "period_month", "period_quarter", "tax_type", "payment_channel",
        "region", "district", "business_sector", "amount", "unique_taxpayers", "transaction_count",
        "avg_payment_amount",
    ]
    text, date = F.lit(None).cast("string"), F.lit(None).cast("date")
    daily = revenue_daily(payments).select(
        F.lit("daily").alias("aggregation_level"),
        F.col("payment_date").alias("period_date"),
        date.alias("period_month"),
        date.alias("period_quarter"),
        "tax_type", "payment_channel", text.alias("region"), text.alias("district"), text.alias("business_sector"),
        F.col("daily_amount").cast("decimal(35,2)").alias("amount"),
        "unique_taxpayers", "transaction_count",
        F.lit(None).cast("double").alias("avg_payment_amount"),
    )

    month, quarter = F.col("revenue_month"), F.col("revenue_quarter")
    profile = taxpayers.select(
        "taxpayer_id", "region", "district", "business_sector", "business_subsector", F.lit(True).alias("known")
    )
    joined = (
        taxpayer_totals(stg_payments(payments), month_start(_day()).alias("revenue_month"), "tax_type")
        .join(profile, "taxpayer_id", "left")
        .withColumn("revenue_quarter", quarter_start(month))
    )
    regional = ["known", "region", "district"]
    sector = ["business_sector", "business_subsector"]
    cube = joined.groupingSets(
        [
            ["tax_type", "revenue_month"],
            ["tax_type", "revenue_month", *regional],
            ["tax_type", "revenue_quarter", *sector],
        ],
        "tax_type", "revenue_month", "revenue_quarter", *regional, *sector,
    ).agg(
        F.sum("amount").alias("amount"),
        F.countDistinct("taxpayer_id").alias("unique_taxpayers"),
        F.sum("payments").alias("transaction_count"),
        F.sum("amounts").alias("amounts"),
        F.grouping("revenue_quarter").alias("no_quarter"),
        F.grouping("region").alias("no_region"),
    )
    level = (
        F.when(F.col("no_quarter") == 0, "sector").when(F.col("no_region") == 0, "regional").otherwise("monthly")
    )
    wanted = (
        (F.col("aggregation_level") == "monthly")
        | ((F.col("aggregation_level") == "regional") & F.col("known"))
        | ((F.col("aggregation_level") == "sector") & F.col("business_sector").isNotNull())
    )
    is_level = F.col("aggregation_level")
    coarse = (
        cube.withColumn("aggregation_level", level)
        .filter(wanted)
        .select(
            "aggregation_level",
            F.coalesce(month, quarter).alias("period_date"),
            month.alias("period_month"),
            quarter.alias("period_quarter"),
            "tax_type", text.alias("payment_channel"), "region", "district", "business_sector", "amount",
            "unique_taxpayers",
            F.when(is_level == "monthly", F.col("transaction_count")).alias("transaction_count"),
            F.when(is_level != "regional", ratio(F.col("amount"), F.col("amounts"))).alias("avg_payment_amount"),
        )
    )
    return daily.unionByName(coarse).select(*columns)


# --- the long metric table ---------------------------------------------------------

METRIC_COLUMNS = [
    "metric_date", "metric_type", "tax_type", "region", "payment_channel", "revenue_amount", "unique_taxpayers",
    "transaction_count",
]


def _metric_rows(df: DataFrame, metric_type: str) -> DataFrame:
    """The common column list; dimensions and counts a metric does not have are typed NULLs."""
    empty = {"region": "string", "payment_channel": "string", "unique_taxpayers": "bigint", "transaction_count": "bigint"}
    missing = {name: F.lit(None).cast(kind) for name, kind in empty.items() if name not in df.columns}
    return df.withColumns({**missing, "metric_type": F.lit(metric_type)}).select(*METRIC_COLUMNS)


def _metric_totals() -> list[Column]:
    return [*_totals("revenue_amount"), F.count(F.lit(1)).alias("transaction_count")]


def metric_daily(payments: DataFrame, as_of: dt.date) -> DataFrame:
    recent = stg_payments(in_period(payments, start=months_before(as_of, 24)))
    return _metric_rows(
        recent.groupBy(_day().alias("metric_date"), "tax_type").agg(*_metric_totals()), "daily_revenue"
    )


def metric_monthly(payments: DataFrame) -> DataFrame:
    grouped = stg_payments(payments).groupBy(month_start(_day()).alias("metric_date"), "tax_type")
    return _metric_rows(grouped.agg(*_metric_totals()), "monthly_revenue")


def metric_regional(payments: DataFrame, taxpayers: DataFrame) -> DataFrame:
    per_taxpayer = taxpayer_totals(stg_payments(payments), month_start(_day()).alias("metric_date"), "tax_type")
    regional = (
        per_taxpayer.join(taxpayers.select("taxpayer_id", "region"), "taxpayer_id")
        .groupBy("metric_date", "tax_type", "region")
        .agg(*_totals("revenue_amount"), F.sum("payments").alias("transaction_count"))
    )
    return _metric_rows(regional, "regional_revenue")


def metric_channel(payments: DataFrame) -> DataFrame:
    grouped = stg_payments(payments).groupBy(month_start(_day()).alias("metric_date"), "tax_type", "payment_channel")
    return _metric_rows(grouped.agg(*_metric_totals()), "channel_revenue")


def year_to_date(*series: str) -> Column:
    """Running sum of the months of a calendar year."""
    window = Window.partitionBy(*series, F.year("metric_date")).orderBy("metric_date")
    return F.sum("revenue_amount").over(window)


def year_over_year(*series: str) -> Column:
    """Change in percent against the month twelve months earlier.

    A range frame on the month number finds that month or nothing, so gaps need no self-join.
    """
    window = Window.partitionBy(*series).orderBy(month_slot(F.col("metric_date"))).rangeBetween(-12, -12)
    return pct_change(F.col("revenue_amount"), F.max("revenue_amount").over(window))


def _trailing_year(as_of: dt.date) -> Column:
    return (F.col("metric_date") >= F.lit(months_before(as_of, 12))) & (F.col("metric_date") < F.lit(as_of))


def target_share(as_of: dt.date, *series: str) -> Column:
    """Month as a percentage of a twelfth of the yearly target; NULL outside the year of ``as_of``."""
    base = F.sum(F.when(_trailing_year(as_of), F.col("revenue_amount"))).over(Window.partitionBy(*series))
    monthly_target = base.cast("double") * C.TARGET_GROWTH / 12
    return F.when(
        F.year("metric_date") == as_of.year, ratio(F.col("revenue_amount"), monthly_target) * 100
    )


def _monthly_series(payments: DataFrame) -> DataFrame:
    return (
        stg_payments(payments)
        .groupBy(month_start(_day()).alias("metric_date"), "tax_type")
        .agg(F.sum("amount").alias("revenue_amount"))
    )


def metric_ytd(payments: DataFrame) -> DataFrame:
    series = _monthly_series(payments)
    return _metric_rows(series.withColumn("revenue_amount", year_to_date("tax_type")), "ytd_revenue")


def metric_yoy(payments: DataFrame) -> DataFrame:
    series = _monthly_series(payments)
    return _metric_rows(series.withColumn("revenue_amount", year_over_year("tax_type")), "yoy_growth")


def yearly_targets(payments: DataFrame, as_of: dt.date) -> DataFrame:
    """Revenue of the trailing year plus 15 %, split by the calendar years it touches."""
    recent = _monthly_series(payments).filter(_trailing_year(as_of))
    return recent.groupBy(F.trunc("metric_date", "year").alias("target_year"), "tax_type").agg(
        (F.sum("revenue_amount").cast("double") * C.TARGET_GROWTH).alias("annual_target")
    )


def metric_target_vs_actual(payments: DataFrame, as_of: dt.date) -> DataFrame:
    """One trailing-year target per tax type, against each month of the year of ``as_of``."""
    series = _monthly_series(payments).withColumn("share", target_share(as_of, "tax_type"))
    return _metric_rows(
        series.filter(F.col("share").isNotNull()).withColumn("revenue_amount", F.col("share")), "target_vs_actual"
    )


def revenue_dashboard_metrics(payments: DataFrame, taxpayers: DataFrame, as_of: dt.date) -> DataFrame:
    """All seven metrics in one long table, from two reads of the payments.

    The daily metric filters on the date and reads only the recent part. Everything monthly comes from one
    pre-aggregation per taxpayer, one join and one grouping-set aggregation; its result is small, and the
    running total, growth and target of a month are added to it as columns before they are unfolded.
    """
    per_taxpayer = taxpayer_totals(
        stg_payments(payments), month_start(_day()).alias("metric_date"), "tax_type", "payment_channel"
    )
    joined = per_taxpayer.join(
        taxpayers.select("taxpayer_id", "region", F.lit(True).alias("known")), "taxpayer_id", "left"
    )
    cube = joined.groupingSets(
        [
            ["metric_date", "tax_type"],
            ["metric_date", "tax_type", "known", "region"],
            ["metric_date", "tax_type", "payment_channel"],
        ],
        "metric_date", "tax_type", "known", "region", "payment_channel",
    ).agg(
        F.sum("amount").alias("revenue_amount"),
        F.countDistinct("taxpayer_id").alias("unique_taxpayers"),
        F.sum("payments").alias("transaction_count"),
        F.grouping("region").alias("no_region"),
        F.grouping("payment_channel").alias("no_channel"),
    )
    level = (
        F.when(F.col("no_region") == 0, "regional_revenue")
        .when(F.col("no_channel") == 0, "channel_revenue")
        .otherwise("monthly_revenue")
    )
    # One series per level, tax type, region and channel: the windows never gather more than its months.
    series = ["level", "tax_type", "known", "region", "payment_channel"]
    measured = (
        cube.withColumn("level", level)
        .filter((F.col("level") != "regional_revenue") | F.col("known"))
        .withColumns(
            {
                "ytd": year_to_date(*series),
                "yoy": year_over_year(*series),
                "share": target_share(as_of, *series),
            }
        )
    )

    def entry(metric_type: Column, value: str, counted: bool) -> Column:
        count = (lambda name: F.col(name)) if counted else (lambda name: F.lit(None).cast("bigint"))
        return F.struct(
            metric_type.alias("metric_type"),
            F.col(value).cast("double").alias("revenue_amount"),
            count("unique_taxpayers").alias("unique_taxpayers"),
            count("transaction_count").alias("transaction_count"),
        )

    own = entry(F.col("level"), "revenue_amount", True)
    derived = [entry(F.lit("ytd_revenue"), "ytd", False), entry(F.lit("yoy_growth"), "yoy", False)]
    target = entry(F.lit("target_vs_actual"), "share", False)
    monthly = F.col("level") == "monthly_revenue"
    entries = (
        F.when(monthly & F.col("share").isNotNull(), F.array(own, *derived, target))
        .when(monthly, F.array(own, *derived))
        .otherwise(F.array(own))
    )
    months = measured.select("metric_date", "tax_type", "region", "payment_channel", F.inline(entries))
    daily = metric_daily(payments, as_of).withColumn("revenue_amount", F.col("revenue_amount").cast("double"))
    return daily.unionByName(months.select(*METRIC_COLUMNS))


def revenue_dashboard_simple(payments: DataFrame, taxpayers: DataFrame) -> DataFrame:
    """The three monthly levels only."""
    full = metric_monthly(payments).unionByName(metric_regional(payments, taxpayers))
    return full.unionByName(metric_channel(payments))


def revenue_summary(payments: DataFrame, taxpayers: DataFrame) -> DataFrame:
    """Day, tax type, channel and region over payments of every status."""
    per_taxpayer = taxpayer_totals(payments, _day().alias("date"), "tax_type", "payment_channel")
    return (
        per_taxpayer.join(taxpayers.select("taxpayer_id", "region"), "taxpayer_id")
        .groupBy("date", "tax_type", "payment_channel", "region")
        .agg(
            F.sum("amount").alias("total_amount"),
            F.sum("payments").alias("transaction_count"),
            F.countDistinct("taxpayer_id").alias("unique_taxpayers"),
        )
    )
