"""Trip rows for tests. Every row is the base row with some fields changed."""

from __future__ import annotations

import datetime as dt
from datetime import datetime

from siltstone.presets import TAXI

AS_OF = "2024-01-01 00:00:00"

RAW_SCHEMA = """vendorid bigint, tpep_pickup_datetime timestamp_ntz,
    tpep_dropoff_datetime timestamp_ntz, passenger_count double, trip_distance double,
    ratecodeid double, store_and_fwd_flag string, pulocationid bigint,
    dolocationid bigint, payment_type bigint, fare_amount double, extra double,
    mta_tax double, tip_amount double, tolls_amount double,
    improvement_surcharge double, total_amount double, congestion_surcharge double,
    airport_fee double"""

BASE = {
    "vendorid": 1,
    "tpep_pickup_datetime": datetime(2023, 1, 5, 10, 0),
    "tpep_dropoff_datetime": datetime(2023, 1, 5, 10, 20),
    "passenger_count": 1.0,
    "trip_distance": 2.0,
    "ratecodeid": 1.0,
    "store_and_fwd_flag": "N",
    "pulocationid": 100,
    "dolocationid": 200,
    "payment_type": 1,
    "fare_amount": 10.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 12.0,
    "congestion_surcharge": 2.5,
    "airport_fee": 0.0,
}


def trip(**changes) -> dict:
    return BASE | changes


def at(minute: int, day: int = 5, month: int = 1) -> dict:
    """A distinct pickup and dropoff."""
    start = datetime(2023, month, day) + dt.timedelta(minutes=minute)
    return {
        "tpep_pickup_datetime": start,
        "tpep_dropoff_datetime": start + dt.timedelta(minutes=20),
    }


def raw_frame(spark, rows: list[dict]):
    return spark.createDataFrame([tuple(r.values()) for r in rows], RAW_SCHEMA)


def spec(**changes):
    import dataclasses

    return dataclasses.replace(TAXI, **changes)
