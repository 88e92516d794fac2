from __future__ import annotations

import datetime as dt
import io
import sys
from contextlib import redirect_stdout
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from forecourt.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("8", "6g", **{"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


class Bag(list):
    """A list that ignores order in comparisons."""

    def __eq__(self, other):
        return sorted(self, key=repr) == sorted(other, key=repr)


def rows(df) -> Bag:
    return Bag(tuple(r) for r in df.collect())


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def final_plan(df) -> str:
    """The plan after a run, with what adaptive execution decided."""
    df.collect()
    return plan(df)


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


@pytest.fixture(scope="session")
def business(spark):
    """A handful of rows of every silver table, with the awkward cases in."""
    stores = spark.createDataFrame(
        [(1, "North", "Tokyo", "plaza"), (2, "South", "Osaka", "import"), (3, "Idle", "Tokyo", "plaza")],
        "store_id long, store_name string, prefecture string, format string",
    )
    vehicles = spark.createDataFrame(
        [
            (10, 1, "M1", "a", "SUV", 2000, 20_000, True, "なし", 100.0, 80.0, "1" * 17, "P-10", day("2001-01-01"), "在庫中"),
            (11, 2, "M2", "b", "セダン", 1995, 30_000, False, "あり", 200.0, 210.0, "2" * 16, "P-11", day("2001-03-01"), "成約済"),
            (12, None, "M1", "a", "SUV", None, None, None, "なし", 300.0, 250.0, None, None, day("2000-01-01"), "在庫中"),
        ],
        "vehicle_id long, store_id long, maker string, model string, body_type string, model_year int,"
        " mileage_km int, certified boolean, repair_history string, listing_price double,"
        " purchase_price double, vin string, plate_number string, stocked_date date, status string",
    )
    customers = spark.createDataFrame(
        [
            (100, "Anna", 1, "East", "HOME", 10.0, "090-1234-5678"),
            (101, "Bo", 2, "West", "WORK", 20.0, "12"),
            (102, None, 2, "West", "WORK", None, None),
        ],
        "customer_id long, name string, registered_store_id long, area string, segment string,"
        " budget double, phone string",
    )
    inquiries = spark.createDataFrame(
        [
            (1000, day("2001-07-02"), 100, 1, 10, "web", "成約"),
            (1001, day("2001-06-30"), 100, 1, 11, "web", "失注"),
            (1002, day("2000-01-15"), 101, 2, 12, "shop", "進行中"),
        ],
        "inquiry_id long, inquiry_date date, customer_id long, store_id long, vehicle_id long,"
        " channel string, status string",
    )
    contracts = spark.createDataFrame(
        [
            (1, 1000, day("2001-07-05"), 100, 1, 10, 100.0, 20.0),
            (2, 1000, day("2001-07-31"), 100, 1, 11, 300.0, 30.0),
            (3, 1001, day("2001-06-10"), 101, 2, 11, 0.0, -5.0),
            (4, None, day("2001-06-11"), 101, None, 99, 50.0, 5.0),
        ],
        "contract_id long, inquiry_id long, contract_date date, customer_id long, store_id long,"
        " vehicle_id long, actual_price double, gross_profit double",
    )
    index = spark.createDataFrame(
        [
            (day("2001-06-01"), "SUV", 10.0),
            (day("2001-06-02"), "SUV", 20.0),
            (day("2001-07-01"), "SUV", 12.0),
            (day("2001-06-01"), "セダン", 5.0),
            (day("2001-07-01"), "セダン", 6.0),
        ],
        "date date, vehicle_category string, market_index double",
    )
    return {
        "sl_stores": stores,
        "sl_vehicles": vehicles,
        "sl_customers": customers,
        "sl_inquiries": inquiries,
        "sl_contracts": contracts,
        "sl_market_index": index,
    }
