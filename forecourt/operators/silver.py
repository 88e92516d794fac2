"""Cleansing, vocabulary alignment and joins on the way to the silver tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.operators.gold import month_of, ratio
from forecourt.operators.joins import broadcast_if_small
from forecourt.operators.text import classify

# The body-type vocabulary, and the spellings that mean the same.
BODY_TYPES = ("軽自動車", "コンパクト", "セダン", "SUV", "ミニバン", "輸入車")
BODY_TYPE_SPELLINGS = {"軽": "軽自動車", "輸入": "輸入車"}


def map_category(column: str | Column, spellings: Mapping[str, str]) -> Column:
    """The canonical category; surrounding space and letter case do not matter.

    ``spellings`` maps accepted spellings to canonical values, which also map to
    themselves. Anything else becomes NULL, for the quality rules to count.
    """
    value = F.upper(F.trim(F.col(column) if isinstance(column, str) else column))
    known = {c.upper(): c for c in spellings.values()} | {k.upper(): v for k, v in spellings.items()}
    lookup = F.create_map(*(F.lit(text) for pair in known.items() for text in pair))
    return F.try_element_at(lookup, value)


def to_silver(
    contracts: DataFrame,
    stores: DataFrame,
    vehicles: DataFrame,
    spellings: Mapping[str, str],
    by_month: bool = False,
) -> DataFrame:
    """Contracts with trimmed names, aligned category, month and margin rate.

    Small sides are joined last, where the rows lie. ``by_month`` gathers the rows by month before that, so
    that what small sides add is not shuffled.
    """
    store = stores.select(
        "store_id",
        F.trim("store_name").alias("store_name"),
        F.trim("prefecture").alias("prefecture"),
    )
    vehicle = vehicles.select(
        "vehicle_id",
        F.trim("maker").alias("maker"),
        map_category("body_type", spellings).alias("category"),
    )
    frames = {"store_id": store, "vehicle_id": vehicle}
    sides = broadcast_if_small(frames)
    small = [key for key in frames if sides[key] is not frames[key]]
    joined = contracts.select(
        "contract_id",
        "contract_date",
        month_of("contract_date").alias("sales_month"),
        "store_id",
        "vehicle_id",
        "customer_id",
        "actual_price",
        "gross_profit",
    )
    for key in (key for key in frames if key not in small):
        joined = joined.join(sides[key], key, "left")
    if by_month:
        joined = joined.hint("rebalance", "sales_month")
    for key in small:
        joined = joined.join(sides[key], key, "left")
    return joined.select(
        "contract_id",
        "contract_date",
        "sales_month",
        "store_id",
        "store_name",
        "prefecture",
        "vehicle_id",
        "maker",
        "category",
        "customer_id",
        "actual_price",
        "gross_profit",
        ratio("gross_profit", "actual_price").alias("margin_rate"),
    )


def enrich_customers(customers: DataFrame, profile: DataFrame, key: str) -> DataFrame:
    """Customers with extracted attributes; an extracted value only fills a gap.

    Attributes the master lacks are added, those it has are kept where not NULL.
    """
    extracted = [c for c in profile.columns if c != key]
    side = profile.select(F.col(key), *(F.col(c).alias(f"_x_{c}") for c in extracted))
    filled = {
        c: F.coalesce(F.col(c), F.col(f"_x_{c}")) if c in customers.columns else F.col(f"_x_{c}")
        for c in extracted
    }
    joined = customers.join(side, key, "left").withColumns(filled)
    return joined.drop(*(f"_x_{c}" for c in extracted))


def enrich_inquiries(
    inquiries: DataFrame,
    notes: DataFrame,
    key: str,
    order: str,
    text: str,
    labels: Mapping[str, Sequence[str]],
    other: str = "other",
) -> DataFrame:
    """Inquiries with the topic of their notes: that of the note scoring highest, the earliest of equals.

    ``topic`` is NULL for an inquiry without notes.
    """
    scored = classify(notes.select(key, order, text), text, labels, other).drop(text)
    best = F.struct("topic_score", -F.col(order))
    topics = scored.groupBy(F.col(key).alias("inquiry_id")).agg(
        F.max_by("topic", best).alias("topic"), F.count(F.lit(1)).alias("notes")
    )
    return inquiries.join(topics, "inquiry_id", "left")
