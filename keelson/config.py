"""Column names, fixed values and tunables shared by every plan.

Everything here is plain data; no Spark objects are created at import time.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values that must equal the reference for equal results -----------------
# Raw header names of the order-line file (bronze), in file order, mapped to the silver
# column each one becomes.
RAW_TO_SILVER: tuple[tuple[str, str], ...] = (
    ("Category Name", "category"),
    ("Product Name", "product"),
    ("Customer City", "cust_city"),
    ("Customer State", "cust_state"),
    ("Customer Country", "cust_country"),
    ("Order City", "order_city"),
    ("Order State", "order_state"),
    ("Order Country", "order_country"),
    ("Order Region", "order_region"),
    ("Delivery Status", "delivery_status"),
    ("Shipping Mode", "ship_mode"),
    ("Days for shipping (real)", "ship_days_real"),
    ("Days for shipment (scheduled)", "ship_days_sched"),
    ("order date (DateOrders)", "order_ts"),
    ("shipping date (DateOrders)", "ship_ts"),
    ("Order Item Total", "sales"),
    ("Order Profit Per Order", "profit"),
    ("Sales per customer", "sales_per_customer"),
    ("Benefit per order", "benefit"),
    ("Order Id", "src_order_id"),
    ("Product Card Id", "src_product_id"),
    ("Customer Id", "src_customer_id"),
)

# The one delivery status the analysis names.
LATE_DELIVERY = "Late delivery"

# Codec of the stored tables that hold every order line.
STORED = "zstd"

# Insight thresholds: margin above 15 % is healthy; late rate above 10 % is a crisis,
# below 5 % excellent; oil-price standard deviation above 10 is volatile.
MARGIN_HEALTHY_PCT = 15.0
LATE_DANGER_PCT = 10.0
LATE_EXCELLENT_PCT = 5.0
PRICE_VOLATILE_STD = 10.0

# Row caps that are the feature itself (chart sizes of the analysis).
TOP_MIX = 5
TOP_LATE_CITIES = 10
TOP_LATE_CITIES_PRIORITY = 3
LOWEST_MARGIN = 8
QUADRANT_TOP = 15
CHAMPIONS = 5

# Silver column order (23 columns).
SILVER_COLUMNS: tuple[str, ...] = (
    "category", "product",
    "cust_city", "cust_state", "cust_country",
    "order_city", "order_state", "order_country", "order_region",
    "delivery_status", "ship_mode", "ship_days_real", "ship_days_sched",
    "order_ts", "ship_ts",
    "sales", "profit", "sales_per_customer", "benefit",
    "oil_price",
    "src_order_id", "src_product_id", "src_customer_id",
)

INT_COLUMNS = ("ship_days_real", "ship_days_sched")
DOUBLE_COLUMNS = ("sales", "profit", "sales_per_customer", "benefit")
TS_COLUMNS = ("order_ts", "ship_ts")
LONG_COLUMNS = ("src_order_id", "src_product_id", "src_customer_id")

# Tokens read as missing in the raw file, on top of the empty field (the default
# missing-value set of a common CSV reader).
NA_TOKENS: tuple[str, ...] = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


@dataclass(frozen=True)
class CleanConfig:
    """Cleaning options of the silver step."""

    fill_category: str = "UNCATEGORIZED"
    fill_product: str = "UNKNOWN"
    fill_country: str = "UNKNOWN"
    fill_state: str = "N/A"
    fill_days: int = 0
    ts_format: str = "M/d/yyyy H:mm"
    default_oil_price: float = 0.0


@dataclass(frozen=True)
class StarConfig:
    """Star-schema options.

    ``geo_keys=3`` joins the customer geography on (city, state, country), keeping the
    fact grain; ``geo_keys=2`` joins on (city, state) only and reproduces the
    reference's fan-out when one (city, state) exists under two countries.
    A dimension estimated within ``broadcast_bytes`` is broadcast; a larger one is joined by
    ``hot_key_left_join``, which no hot key can stall.
    """

    geo_keys: int = 3
    broadcast_bytes: int = 64 << 20


@dataclass(frozen=True)
class Dims:
    """Which dimensions a flattening may use (the reference joins only those present)."""

    product: bool = True
    customer_geo: bool = True
    logistics: bool = True
    time: bool = True

    def names(self) -> list[str]:
        return [n for n, on in (("product", self.product), ("customer_geo", self.customer_geo),
                                ("logistics", self.logistics), ("time", self.time)) if on]


DEFAULT_CLEAN = CleanConfig()
DEFAULT_STAR = StarConfig()
ALL_DIMS = Dims()
