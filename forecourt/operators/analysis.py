"""Business questions over the silver tables.

Every function takes the logical tables by name and, where a period is relative,
the day ``as_of`` it counts back from. Thresholds and period lengths are
defaults of this project and can be passed in. Facts are aggregated before they
are joined or ranked, so windows run over months or groups, never over rows of
a fact.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.functions.bands import band
from forecourt.operators import gold
from forecourt.operators.gold import month_of, ratio
from forecourt.operators.joins import BROADCAST_BYTES, fits_broadcast
from forecourt.operators.ranking import ranked

Tables = Mapping[str, DataFrame]

# Sums are compared and ranked at this precision, so that the order in which a
# cluster adds doubles cannot change a rank.
_CENTS = 4


def _sum(column: str) -> Column:
    return F.round(F.sum(column), _CENTS).alias(column)


def _count() -> Column:
    return F.count(F.lit(1))


def months_before(as_of: dt.date, n: int) -> dt.date:
    """First day of the month ``n`` months before the month of ``as_of``."""
    index = as_of.year * 12 + as_of.month - 1 - n
    return dt.date(index // 12, index % 12 + 1, 1)


def _between(column: str, start: dt.date, end: dt.date) -> Column:
    return (F.col(column) >= F.lit(start)) & (F.col(column) < F.lit(end))


def _contracts(tables: Tables, start: dt.date, end: dt.date) -> DataFrame:
    """Contracts of a period; tables that know a shorter way to them are asked for it."""
    shorter = getattr(tables, "contracts_between", None)
    if shorter is not None:
        return shorter(start, end)
    return tables["sl_contracts"].filter(_between("contract_date", start, end))


def _previous_month(tables: Tables, as_of: dt.date) -> DataFrame:
    return _contracts(tables, months_before(as_of, 1), months_before(as_of, 0))


def top_store_prev_month(tables: Tables, as_of: dt.date) -> DataFrame:
    """The store with the highest gross profit in the month before ``as_of``.

    Contracts without a store compete for nobody; a store that the master lacks wins without a name.
    """
    best = (
        _previous_month(tables, as_of)
        .filter("store_id IS NOT NULL")
        .groupBy("store_id")
        .agg(_sum("gross_profit"))
        .orderBy(F.desc("gross_profit"), "store_id")
        .limit(1)
    )
    named = tables["sl_stores"].select("store_id", "store_name")
    return best.join(named, "store_id", "left").select("store_id", "gross_profit", "store_name")


def _ranked(df: DataFrame, value: str, in_one_task: bool) -> DataFrame:
    """``df`` with the ``rank`` and ``dense_rank`` of ``value`` within each month."""
    df = df.filter(F.col("month").isNotNull() & F.col(value).isNotNull())
    if not in_one_task:
        return ranked(df, "month", value)
    best_first = Window.partitionBy("month").orderBy(F.desc(value))
    return df.withColumns(
        {"rank": F.rank().over(best_first), "dense_rank": F.dense_rank().over(best_first)}
    )


def store_ranking(
    tables: Tables, broadcast_bytes: int = BROADCAST_BYTES, window_rows: int = 1_000_000
) -> DataFrame:
    """Stores by gross profit within each month, next to the rank of their area.

    ``store_rank`` leaves gaps after ties; ``area_rank``, by the area's total of
    the month, does not. Contracts without date or profit are not ranked. A
    month's window holds one row per store that has contracts, known to the
    master or not; if no month has more than ``window_rows``, one task can sort
    it, otherwise the months are ranked in pieces.
    """
    stores = tables["sl_stores"].select("store_id", "prefecture")
    near = fits_broadcast(stores, broadcast_bytes)
    monthly = (
        tables["sl_contracts"]
        .groupBy(month_of("contract_date").alias("month"), "store_id")
        .agg(_sum("gross_profit"))
        .join(F.broadcast(stores) if near else stores, "store_id", "left")
    )
    largest = monthly.groupBy("month").count().agg(F.max("count")).first()[0] or 0
    few = largest <= window_rows
    areas = monthly.groupBy("month", F.col("prefecture").alias("area")).agg(
        F.round(F.sum("gross_profit"), _CENTS).alias("area_profit")
    )
    areas = _ranked(areas, "area_profit", few).select(
        F.col("month").alias("area_month"), "area", "area_profit", F.col("dense_rank").alias("area_rank")
    )
    same_area = (F.col("month") == F.col("area_month")) & F.col("prefecture").eqNullSafe(
        F.col("area")
    )
    return (
        _ranked(monthly, "gross_profit", few)
        .withColumnRenamed("rank", "store_rank")
        .join(areas, same_area, "left")
        .select(
            "month",
            "store_id",
            "prefecture",
            "gross_profit",
            "store_rank",
            "area_profit",
            "area_rank",
        )
    )


def top3_segment(
    tables: Tables, k: int = 3, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The ``k`` most contracted models in each customer segment; ties go by model name.

    Unless both dimensions fit a broadcast, contracts are counted per (customer,
    vehicle), then per (segment, vehicle), so neither join carries more rows of
    one customer or vehicle than it has partners.
    """
    customers = tables["sl_customers"].select("customer_id", "segment")
    vehicles = tables["sl_vehicles"].select("vehicle_id", "model")
    deals = tables["sl_contracts"].select("customer_id", "vehicle_id")
    if fits_broadcast(customers, broadcast_bytes) and fits_broadcast(vehicles, broadcast_bytes):
        counted = (
            deals.join(F.broadcast(customers), "customer_id")
            .join(F.broadcast(vehicles), "vehicle_id")
            .groupBy("segment", "model")
            .agg(_count().alias("units"))
        )
    else:
        counted = (
            deals.groupBy("customer_id", "vehicle_id")
            .agg(_count().alias("units"))
            .join(customers, "customer_id")
            .groupBy("segment", "vehicle_id")
            .agg(F.sum("units").alias("units"))
            .join(vehicles, "vehicle_id")
            .groupBy("segment", "model")
            .agg(F.sum("units").alias("units"))
        )
    order = Window.partitionBy("segment").orderBy(F.desc("units"), "model")
    return counted.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def _month_before(value: str, group: str, month: str = "month") -> Column:
    """``value`` of the calendar month before, NULL if that month has no row; months must not be NULL."""
    by_month = Window.partitionBy(group).orderBy(month)
    follows = F.lag(month).over(by_month) == F.add_months(month, -1)
    return F.when(follows, F.lag(value).over(by_month))


def falling_index_sales(tables: Tables) -> DataFrame:
    """Sales of each category in the months when its market index fell from the calendar month before."""
    index = gold.monthly_index(tables["sl_market_index"]).filter("month IS NOT NULL")
    index = index.withColumn("index_change", F.col("market_index") - _month_before("market_index", "category"))
    sales = gold.sales_by_vehicle_attribute(
        tables["sl_contracts"],
        tables["sl_vehicles"],
        "body_type",
        month_of("contract_date").alias("month"),
    ).withColumnRenamed("body_type", "category")
    return (
        index.filter("index_change < 0")
        .join(sales, ["month", "category"])
        .select("month", "category", "market_index", "index_change", "units", "sales")
    )


def margin_by_repair(tables: Tables) -> DataFrame:
    """Margin rate of each store for repaired and for unrepaired vehicles."""
    by_store = gold.sales_by_vehicle_attribute(
        tables["sl_contracts"], tables["sl_vehicles"], "repair_history", "store_id"
    )

    def rate(answer: str) -> Column:
        chosen = F.col("repair_history") == answer
        sales = F.sum(F.when(chosen, F.col("sales")))
        return F.sum(F.when(chosen, F.col("gross_profit"))) / F.nullif(sales, F.lit(0.0))

    return by_store.groupBy("store_id").agg(
        F.sum("units").alias("units"),
        rate("あり").alias("margin_repaired"),
        rate("なし").alias("margin_unrepaired"),
    )


def market_gap(tables: Tables) -> DataFrame:
    """How far the market index and the margin rate drift apart, by month and category.

    Each is divided by its category's mean over all months; the gap is the
    difference of the two. The window holds one row per month.
    """
    category = Window.partitionBy("category")
    return (
        gold.market_linked_margin(
            tables["sl_contracts"], tables["sl_vehicles"], tables["sl_market_index"]
        )
        .withColumn("index_level", F.col("market_index") / F.avg("market_index").over(category))
        .withColumn(
            "margin_level",
            F.col("margin_rate") / F.nullif(F.avg("margin_rate").over(category), F.lit(0.0)),
        )
        .withColumn("gap", F.col("index_level") - F.col("margin_level"))
        .select("month", "category", "market_index", "margin_rate", "index_level", "gap")
    )


IN_STOCK = "在庫中"


def turnover_days(
    tables: Tables, as_of: dt.date, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Days from stocking to contract, and days in stock so far, by body type.

    Contracts dated before the vehicle was stocked are left out. Unless the
    vehicles fit a broadcast, contracts are counted per vehicle and day first.
    """
    vehicles = tables["sl_vehicles"].select("vehicle_id", "body_type", "stocked_date", "status")
    stocked = vehicles.select("vehicle_id", "body_type", "stocked_date")
    deals = tables["sl_contracts"].select("vehicle_id", "contract_date")
    if fits_broadcast(stocked, broadcast_bytes):
        deals, stocked = deals.withColumn("units", F.lit(1)), F.broadcast(stocked)
    else:
        deals = deals.groupBy("vehicle_id", "contract_date").agg(_count().alias("units"))
    sold = (
        deals.join(stocked, "vehicle_id")
        .filter("contract_date >= stocked_date")
        .withColumn("days", F.datediff("contract_date", "stocked_date"))
        .groupBy("body_type")
        .agg(
            F.sum("units").alias("units_sold"),
            (F.sum(F.col("days") * F.col("units")) / F.sum("units")).alias("avg_days_to_sale"),
        )
    )
    open_stock = (
        vehicles.filter(F.col("status") == IN_STOCK)
        .groupBy("body_type")
        .agg(
            _count().alias("units_in_stock"),
            F.avg(F.datediff(F.lit(as_of), "stocked_date")).alias("avg_days_in_stock"),
        )
    )
    open_stock = open_stock.withColumnRenamed("body_type", "stock_type")
    return sold.join(open_stock, F.col("body_type").eqNullSafe(F.col("stock_type")), "full").select(
        F.coalesce("body_type", "stock_type").alias("body_type"),
        "units_sold",
        "avg_days_to_sale",
        "units_in_stock",
        "avg_days_in_stock",
    )


def aged_stock(
    tables: Tables,
    as_of: dt.date,
    min_days: int = 180,
    edges: Sequence[tuple[int, str]] = ((270, "180-270"), (365, "271-365"), (455, "366-455")),
    beyond: str = "456+",
) -> DataFrame:
    """Vehicles in stock for at least ``min_days``, by body type and band of days."""
    days = F.datediff(F.lit(as_of), "stocked_date")
    return (
        tables["sl_vehicles"]
        .filter((F.col("status") == IN_STOCK) & (days >= min_days))
        .withColumn("days", days)
        .groupBy("body_type", F.expr(band("days", edges, beyond)).alias("days_band"))
        .agg(_count().alias("vehicles"), _sum("listing_price"), F.max("days").alias("max_days"))
    )


def funnel(tables: Tables) -> DataFrame:
    """Inquiries, inquiries won, and inquiries with at least one contract, by channel and store."""
    closed = (
        tables["sl_contracts"].groupBy("inquiry_id").agg(_sum("actual_price"), _count().alias("n"))
    )
    return (
        tables["sl_inquiries"]
        .join(closed, "inquiry_id", "left")
        .groupBy("channel", "store_id")
        .agg(
            _count().alias("inquiries"),
            F.count_if(F.col("status") == "成約").alias("won"),
            F.count("n").alias("with_contract"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("contracts"),
            F.coalesce(F.round(F.sum("actual_price"), _CENTS), F.lit(0.0)).alias("sales"),
        )
        .withColumn("contract_rate", ratio("with_contract", "inquiries"))
    )


def store_decline(tables: Tables, drop: float = 0.3, months: int = 3) -> DataFrame:
    """Store months whose gross profit fell by at least ``drop`` against the mean of the months before.

    Every store has a row for each calendar month from its first contract to the last month of the data, with 0
    where it sold nothing, so a store that stops selling is reported. The comparison takes the ``months`` months
    before, which must lie after the store's first one and have a positive mean. Contracts without store or date
    belong to no store month.
    """
    monthly = (
        tables["sl_contracts"]
        .filter("store_id IS NOT NULL AND contract_date IS NOT NULL")
        .groupBy("store_id", month_of("contract_date").alias("month"))
        .agg(_sum("gross_profit"))
    )
    last = monthly.agg(F.max("month")).scalar()
    calendar = monthly.groupBy("store_id").agg(F.min("month").alias("first")).select(
        "store_id", F.explode(F.sequence("first", last, F.expr("INTERVAL 1 MONTH"))).alias("month")
    )
    before = Window.partitionBy("store_id").orderBy("month").rowsBetween(-months, -1)
    return (
        calendar.join(monthly, ["store_id", "month"], "left")
        .na.fill(0.0, ["gross_profit"])
        .withColumn("earlier_mean", F.avg("gross_profit").over(before))
        .withColumn("earlier_months", F.count("gross_profit").over(before))
        .filter((F.col("earlier_months") == months) & (F.col("earlier_mean") > 0))
        .withColumn("change", F.col("gross_profit") / F.col("earlier_mean") - 1)
        .filter(F.col("change") <= -drop)
        .drop("earlier_months")
    )


def correlation(x: str, y: str) -> Column:
    """Pearson correlation; NULL if either side is constant (``corr`` would fail on that)."""
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))


def store_corr(tables: Tables) -> DataFrame:
    """Correlation of store sales with inquiries won, value of stock and its customers' budgets.

    Every store of the master counts, with 0 for what it does not have.
    """
    sales = tables["sl_contracts"].groupBy("store_id").agg(_sum("actual_price"))
    won = (
        tables["sl_inquiries"]
        .groupBy("store_id")
        .agg(F.count_if(F.col("status") == "成約").cast("double").alias("won"))
    )
    stock = (
        tables["sl_vehicles"].groupBy("store_id").agg(F.sum("listing_price").alias("stock_value"))
    )
    budgets = (
        tables["sl_customers"]
        .groupBy(F.col("registered_store_id").alias("store_id"))
        .agg(F.sum("budget").alias("budgets"))
    )
    per_store = tables["sl_stores"].select("store_id")
    for figures in (sales, won, stock, budgets):
        per_store = per_store.join(figures, "store_id", "left")
    per_store = per_store.na.fill(0.0, ["actual_price", "won", "stock_value", "budgets"])
    return per_store.agg(
        _count().alias("stores"),
        *(
            correlation("actual_price", other).alias(f"sales_vs_{other}")
            for other in ("won", "stock_value", "budgets")
        ),
    )


def heatmap(tables: Tables, as_of: dt.date, months: int = 12) -> DataFrame:
    """Units and margin rate by store, one column pair for each of the last ``months`` months."""
    first = [months_before(as_of, n) for n in range(months, -1, -1)]
    wanted = _contracts(tables, first[0], first[-1])
    cells = []
    for month in first[:-1]:
        label = f"{month:%Y_%m}"
        here = F.col("month") == F.lit(month)
        sales = F.sum(F.when(here, F.col("sales")))
        profit = F.sum(F.when(here, F.col("gross_profit")))
        cells += [
            F.coalesce(F.sum(F.when(here, F.col("units"))), F.lit(0)).alias(f"units_{label}"),
            F.round(profit / F.nullif(sales, F.lit(0.0)), 6).alias(f"margin_{label}"),
        ]
    monthly = gold.store_monthly_sales(wanted).withColumnRenamed("sales_month", "month")
    return monthly.groupBy("store_id").agg(*cells)


def composition(tables: Tables) -> DataFrame:
    """Share of each category in units and in sales."""
    by_category = gold.sales_by_vehicle_attribute(
        tables["sl_contracts"], tables["sl_vehicles"], "body_type"
    )
    # The totals are single values, so no task has to hold all categories.
    units, sales = (by_category.agg(F.sum(c)).scalar() for c in ("units", "sales"))
    return by_category.select(
        "body_type",
        "units",
        F.round("sales", _CENTS).alias("sales"),
        (F.col("units") / units).alias("unit_share"),
        (F.col("sales") / sales).alias("sales_share"),
    )


def scatter(tables: Tables, share: float | None = None) -> DataFrame:
    """Model year against listing price, coloured by body type.

    A plot of very many points can take a repeatable ``share`` of the vehicles,
    chosen by a hash of the key.
    """
    points = tables["sl_vehicles"].select("vehicle_id", "model_year", "listing_price", "body_type")
    if share is None:
        return points
    return points.filter(F.pmod(F.xxhash64("vehicle_id"), F.lit(10_000)) < int(share * 10_000))


def ltv(tables: Tables, as_of: dt.date) -> DataFrame:
    """Customers, buyers and value per customer, by market segment."""
    segments = gold.rm_segment(
        tables["sl_customers"], tables["sl_inquiries"], tables["sl_contracts"], as_of
    )
    return (
        segments.join(tables["sl_customers"].select("customer_id", "segment"), "customer_id")
        .groupBy("segment")
        .agg(
            _count().alias("customers"),
            F.count_if(F.col("n_contracts") > 0).alias("buyers"),
            _sum("total_value"),
            F.avg("total_value").alias("value_per_customer"),
            (F.sum("total_value") / F.nullif(F.sum("n_contracts"), F.lit(0))).alias(
                "value_per_contract"
            ),
        )
    )


def dormant(tables: Tables, as_of: dt.date, months: int = 12) -> DataFrame:
    """Customers without contact for more than ``months`` whole months, or without any contact at all.

    Contact is an inquiry or a contract.
    """
    segments = gold.rm_segment(
        tables["sl_customers"], tables["sl_inquiries"], tables["sl_contracts"], as_of
    )
    return segments.filter(F.col("months_since").isNull() | (F.col("months_since") > months)).select(
        "customer_id", "months_since", "rm_segment", F.round("total_value", _CENTS).alias("total_value")
    )


def vip_churn(tables: Tables, as_of: dt.date, months: int = 6) -> DataFrame:
    """Customers of the top value band without contact for at least ``months`` months."""
    segments = gold.rm_segment(
        tables["sl_customers"], tables["sl_inquiries"], tables["sl_contracts"], as_of
    )
    away = F.col("months_since").isNull() | (F.col("months_since") >= months)
    lost = (F.col("value_band") == gold.VALUE_BEYOND) & away
    return segments.filter(lost).select(
        "customer_id", "months_since", "n_contracts", F.round("total_value", _CENTS).alias("total_value")
    )


def margin_drop(tables: Tables, as_of: dt.date, months: int = 3) -> DataFrame:
    """Change of gross profit between two periods, split by its causes, per body type.

    The later period is the ``months`` months before ``as_of``, the earlier one
    the same number before that. With units u, mean price p and margin rate m:
    volume = (u1 - u0) p0 m0, price = u1 (p1 - p0) m0, margin = u1 p1 (m1 - m0).
    """
    start, middle, end = (months_before(as_of, n) for n in (2 * months, months, 0))
    wanted = _contracts(tables, start, end)
    sums = gold.sales_by_vehicle_attribute(
        wanted,
        tables["sl_vehicles"],
        "body_type",
        (F.col("contract_date") >= F.lit(middle)).alias("late"),
    )

    # One row per body type, NULL included: both periods come from one aggregate without a join.
    periods = sums.groupBy("body_type").agg(
        *(
            F.coalesce(F.sum(F.when(F.col("late") == late, F.col(figure))), F.lit(0)).alias(f"{short}{int(late)}")
            for late in (False, True)
            for figure, short in (("units", "u"), ("sales", "s"), ("gross_profit", "g"))
        )
    )
    both = periods.select(
        "*",
        *(ratio(f"s{n}", f"u{n}").alias(f"p{n}") for n in (0, 1)),
        *(ratio(f"g{n}", f"s{n}").alias(f"m{n}") for n in (0, 1)),
    ).na.fill(0, ["p0", "p1", "m0", "m1"])
    u0, p0, m0, u1, p1, m1 = (F.col(c) for c in ("u0", "p0", "m0", "u1", "p1", "m1"))
    return both.select(
        "body_type",
        u0.alias("units_before"),
        u1.alias("units_after"),
        (F.col("g1") - F.col("g0")).alias("profit_change"),
        ((u1 - u0) * p0 * m0).alias("volume_effect"),
        (u1 * (p1 - p0) * m0).alias("price_effect"),
        (u1 * p1 * (m1 - m0)).alias("margin_effect"),
    )


def top_model_prev_month(tables: Tables, as_of: dt.date) -> DataFrame:
    """The most contracted model in the month before ``as_of``; ties go by model name."""
    by_model = gold.sales_by_vehicle_attribute(
        _previous_month(tables, as_of), tables["sl_vehicles"], "model"
    )
    return by_model.select("model", "units").orderBy(F.desc("units"), "model").limit(1)


def trend(tables: Tables) -> DataFrame:
    """Monthly sales per body type with month-on-month change and three-month mean.

    Both go by the calendar: the change is NULL after a month without sales, and the mean is taken over the
    months with sales among the three. Contracts without date belong to no month.
    """
    sales = gold.sales_by_vehicle_attribute(
        tables["sl_contracts"],
        tables["sl_vehicles"],
        "body_type",
        month_of("contract_date").alias("month"),
    ).filter("month IS NOT NULL")
    number = F.year("month") * 12 + F.month("month")
    three = Window.partitionBy("body_type").orderBy(number).rangeBetween(-2, 0)
    return sales.select(
        "body_type",
        "month",
        "units",
        F.round("sales", _CENTS).alias("sales"),
        (F.col("sales") / F.nullif(_month_before("sales", "body_type"), F.lit(0.0)) - 1).alias("change"),
        F.avg("sales").over(three).alias("three_month_mean"),
    )


def seasonal_forecast(
    monthly: DataFrame, group: str, value: str, end: dt.date, horizon: int = 3, holdout: int = 3
) -> DataFrame:
    """The next ``horizon`` months of each group from ``end`` on: group, month, forecast, backtest_mae, n_months.

    ``monthly`` has one row per group and month (its column ``month``, a first day); months before ``end`` are known, a month
    without a row counts as 0 from the group's first one on. A forecast is a straight line through the known months plus the mean
    distance of its calendar month from that line (0 if never seen; the mean value where one month is known). ``backtest_mae`` is
    the mean absolute error over the last ``holdout`` known months when only those before them are used; NULL without such.

    Windows run over the months of one group, which are few.
    """
    known = monthly.filter(F.col("month") < F.lit(end)).select(F.col(group), "month", F.col(value).cast("double").alias("_value"))
    first = known.groupBy(group).agg(F.min("month").alias("_first"))
    until = F.add_months(F.lit(end), horizon - 1)
    # Every month of the calendar, empty beside the known ones, so that no join has to match groups that are NULL.
    spine = first.select(group, F.explode(F.sequence("_first", until, F.expr("INTERVAL 1 MONTH"))).alias("month"))
    empty = spine.withColumn("_value", F.lit(None).cast("double"))
    rows = known.unionByName(empty).groupBy(group, "month").agg(F.sum("_value").alias("_value"))
    of_group = Window.partitionBy(group)
    rows = rows.withColumn("_at", F.months_between("month", F.min("month").over(of_group)))
    past = F.col("month") < F.lit(end)
    rows = rows.withColumn("_value", F.when(past, F.coalesce("_value", F.lit(0.0))))
    rows = rows.withColumn("_before", F.when(F.col("month") < F.add_months(F.lit(end), -holdout), F.col("_value")))
    of_season = Window.partitionBy(group, F.month("month"))
    for seen, out in (("_value", "forecast"), ("_before", "_back")):
        level = F.coalesce(F.regr_intercept(seen, "_at").over(of_group), F.avg(seen).over(of_group))
        rise = F.coalesce(F.regr_slope(seen, "_at").over(of_group), F.lit(0.0))
        rows = rows.withColumn("_line", level + rise * F.col("_at"))
        season = F.avg(F.col(seen) - F.col("_line")).over(of_season)
        rows = rows.withColumn(out, F.col("_line") + F.coalesce(season, F.lit(0.0)))
    missed = F.when(F.col("_before").isNull(), F.abs(F.col("_value") - F.col("_back")))
    rows = rows.withColumns({"backtest_mae": F.avg(missed).over(of_group), "n_months": F.count("_value").over(of_group)})
    return rows.filter(~past).select(group, "month", "forecast", "backtest_mae", "n_months")
