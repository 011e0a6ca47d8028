"""Trip files whose types drift between months, written with the names the landing uses."""

from __future__ import annotations

from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq

MONEY = ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount", "congestion_surcharge")


def trip(pickup: str, dropoff: str, **values) -> dict:
    base = {
        "VendorID": 1,
        "pickup": datetime.fromisoformat(pickup),
        "dropoff": datetime.fromisoformat(dropoff),
        "passenger_count": 1,
        "trip_distance": 2.5,
        "RatecodeID": 1,
        "store_and_fwd_flag": "N",
        "PULocationID": 10,
        "DOLocationID": 20,
        "payment_type": 1,
        **dict.fromkeys(MONEY, 1.0),
        "fare_amount": 10.0,
        "total_amount": 12.0,
        "airport_fee": 1.25,
        "ehail_fee": None,
        "trip_type": 1,
    }
    return base | values


def write(path, rows: list[dict], prefix: str, columns: list[tuple[str, pa.DataType]]) -> None:
    names = {f"{prefix}_pickup_datetime": "pickup", f"{prefix}_dropoff_datetime": "dropoff", "Airport_fee": "airport_fee"}
    data = {name: pa.array([r[names.get(name, name)] for r in rows], kind) for name, kind in columns}
    pq.write_table(pa.table(data), path)


def yellow_columns(key=pa.int64(), count=pa.float64(), fee="airport_fee", extra=()):
    stamp = pa.timestamp("us")
    return [
        ("VendorID", key),
        ("tpep_pickup_datetime", stamp),
        ("tpep_dropoff_datetime", stamp),
        ("passenger_count", count),
        ("trip_distance", pa.float64()),
        ("RatecodeID", count),
        ("store_and_fwd_flag", pa.string()),
        ("PULocationID", key),
        ("DOLocationID", key),
        ("payment_type", pa.int64()),
        *[(m, pa.float64()) for m in MONEY],
        (fee, pa.float64()),
        *extra,
    ]


def green_columns():
    stamp = pa.timestamp("us")
    return [
        ("VendorID", pa.int32()),
        ("lpep_pickup_datetime", stamp),
        ("lpep_dropoff_datetime", stamp),
        ("store_and_fwd_flag", pa.string()),
        ("RatecodeID", pa.int64()),
        ("PULocationID", pa.int32()),
        ("DOLocationID", pa.int32()),
        ("passenger_count", pa.int64()),
        ("trip_distance", pa.float64()),
        *[(m, pa.float64()) for m in MONEY],
        ("ehail_fee", pa.float64()),
        ("payment_type", pa.int64()),
        ("trip_type", pa.int64()),
    ]


JANUARY = [
    trip("2023-01-05T10:00:00", "2023-01-05T10:30:00"),
    trip("2023-01-01T00:00:00", "2023-01-01T00:10:00", passenger_count=None),
    trip("2023-02-01T00:00:00", "2023-02-01T00:10:00"),
    trip("2023-01-06T10:00:00", "2023-01-06T10:00:00"),
    trip("2023-01-07T10:00:00", "2023-01-07T10:05:00", trip_distance=0.0),
    trip("2023-01-08T10:00:00", "2023-01-08T10:05:00", fare_amount=-3.0, trip_distance=-1.0),
    trip("2023-01-09T10:00:00", "2023-01-09T10:05:00", fare_amount=None),
    trip("2023-01-10T10:00:00", "2023-01-10T10:05:00", total_amount=4.0),
    trip("2023-01-10T10:00:00", "2023-01-10T10:05:00", total_amount=-4.0),
]
MAY = [
    trip("2023-05-01T00:00:00", "2023-05-01T00:10:00", VendorID=2),
    trip("2023-05-02T08:00:00", "2023-05-02T08:30:00", VendorID=6, PULocationID=None),
]
TEXT_KEYS = [trip("2023-06-03T08:00:00", "2023-06-03T08:30:00", VendorID="2", PULocationID="x9", DOLocationID="30")]
GREEN = [
    trip("2023-01-03T08:00:00", "2023-01-03T08:20:00", VendorID=2, ehail_fee=0.5),
    trip("2023-01-04T08:00:00", "2023-01-04T08:20:00", VendorID=9),
]


def write_landing(folder) -> None:
    write(folder / "yellow_tripdata_2023-01.parquet", JANUARY, "tpep", yellow_columns())
    may = [r | {"surge": "yes"} for r in MAY]
    write(folder / "yellow_tripdata_2023-05.parquet", may, "tpep", yellow_columns(pa.int32(), pa.int64(), "Airport_fee", [("surge", pa.string())]))
    write(folder / "green_tripdata_2023-01.parquet", GREEN, "lpep", green_columns())


def write_june(folder) -> None:
    write(folder / "yellow_tripdata_2023-06.parquet", TEXT_KEYS, "tpep", yellow_columns(pa.string()))
