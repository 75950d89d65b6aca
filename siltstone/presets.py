"""Ready-made dataset descriptions."""

from __future__ import annotations

from siltstone.config import PROCESSED_AT, DatasetSpec, GoldColumns
from siltstone.operators.checks import (
    HasColumns,
    MinRows,
    NoDuplicates,
    NoNulls,
    NonNegative,
    NotEmpty,
)
from siltstone.operators.routing import non_negative, not_future, not_null, positive

# Payment codes of the trip records and their labels.
PAYMENT_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided",
}

# Columns of the raw trip records and their common types.
_TAXI_LONGS = ("vendorid", "pulocationid", "dolocationid", "payment_type")
_TAXI_DOUBLES = (
    "passenger_count",
    "trip_distance",
    "ratecodeid",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
)
# The columns that identify a trip.
_TRIP_KEY = (
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "pickup_location_id",
    "dropoff_location_id",
)


def taxi(min_rows: int = 1_000_000) -> DatasetSpec:
    """Monthly taxi trip records; ``min_rows`` is the gate's row threshold."""
    return DatasetSpec(
        # The flag is text already, unless a month has none: then it has no type.
        raw_casts={c: "bigint" for c in _TAXI_LONGS}
        | {c: "double" for c in _TAXI_DOUBLES}
        | {"store_and_fwd_flag": "string"},
        # Names and types of the clean table.
        renames={
            "vendorid": "vendor_id",
            "tpep_pickup_datetime": "pickup_datetime",
            "tpep_dropoff_datetime": "dropoff_datetime",
            "ratecodeid": "rate_code_id",
            "pulocationid": "pickup_location_id",
            "dolocationid": "dropoff_location_id",
        },
        casts={
            "vendor_id": "int",
            "passenger_count": "int",
            "rate_code_id": "int",
            "payment_type": "int",
            "pickup_location_id": "int",
            "dropoff_location_id": "int",
            "fare_amount": "decimal(10,2)",
            "tip_amount": "decimal(10,2)",
            "tolls_amount": "decimal(10,2)",
            "total_amount": "decimal(10,2)",
            "trip_distance": "decimal(10,2)",
        },
        event_time="pickup_datetime",
        event_prefix="pickup",
        rules=(
            not_null("vendor_id"),
            not_null("pickup_datetime"),
            not_null("dropoff_datetime"),
            positive("trip_distance"),
            non_negative("fare_amount"),
            non_negative("total_amount"),
            positive("passenger_count"),
            not_future("pickup_datetime"),
        ),
        dedup_keys=_TRIP_KEY,
        checks=(
            NotEmpty(),
            MinRows(min_rows),
            NoNulls(_TRIP_KEY),
            NoDuplicates(_TRIP_KEY),
            NonNegative(("fare_amount", "total_amount", "trip_distance")),
            HasColumns(
                (
                    "vendor_id",
                    "pickup_datetime",
                    "dropoff_datetime",
                    "passenger_count",
                    "trip_distance",
                    "fare_amount",
                    "total_amount",
                    "pickup_date",
                    "pickup_year",
                    "pickup_month",
                    PROCESSED_AT,
                )
            ),
        ),
        # The zones are a fixed list of a few hundred: one task can rank them.
        gold=GoldColumns(labels=PAYMENT_LABELS, rank_mode="window"),
    )


def lineitem(min_rows: int = 1) -> DatasetSpec:
    """Order lines read as trips: the ship date is the event time, the supplier
    the location, the line number the category."""
    key = ("order_id", "line_number")
    return DatasetSpec(
        raw_casts={
            "l_orderkey": "bigint",
            "l_partkey": "bigint",
            "l_suppkey": "bigint",
            "l_linenumber": "bigint",
            "l_quantity": "double",
            "l_extendedprice": "double",
            "l_discount": "double",
            "l_tax": "double",
        },
        renames={
            "l_orderkey": "order_id",
            "l_partkey": "part_id",
            "l_suppkey": "supplier_id",
            "l_linenumber": "line_number",
            "l_quantity": "quantity",
            "l_extendedprice": "price",
            "l_discount": "discount",
            "l_tax": "tax",
            "l_returnflag": "return_flag",
            "l_linestatus": "line_status",
            "l_shipdate": "shipped_at",
        },
        casts={
            "order_id": "int",
            "part_id": "int",
            "supplier_id": "int",
            "line_number": "int",
            "quantity": "int",
            "price": "decimal(10,2)",
            "discount": "decimal(10,2)",
            "tax": "decimal(10,2)",
        },
        event_time="shipped_at",
        event_prefix="ship",
        rules=(
            not_null("supplier_id"),
            not_null("shipped_at"),
            positive("discount"),
            non_negative("price"),
            non_negative("tax"),
            positive("quantity"),
            not_future("shipped_at"),
        ),
        dedup_keys=key,
        checks=(
            NotEmpty(),
            MinRows(min_rows),
            NoNulls((*key, "supplier_id", "shipped_at")),
            NoDuplicates(key),
            NonNegative(("price", "discount", "tax")),
            HasColumns((*key, "ship_date", "ship_year", "ship_month", PROCESSED_AT)),
        ),
        gold=GoldColumns(
            date="ship_date",
            year="ship_year",
            month="ship_month",
            location="supplier_id",
            category="line_number",
            amount="price",
            distance="discount",
            tip="tax",
            passengers="quantity",
            labels=PAYMENT_LABELS,
        ),
    )


TAXI = taxi()
LINEITEM = lineitem()
