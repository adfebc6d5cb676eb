"""Fixed schemas of the trip data. Every field is nullable."""

from __future__ import annotations

from pyspark.sql import types as T

INT, LONG, DOUBLE = T.IntegerType(), T.LongType(), T.DoubleType()
TEXT, TIME, DATE = T.StringType(), T.TimestampType(), T.DateType()


def struct(**fields) -> T.StructType:
    """Schema from name = type."""
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Column names and types of the public trip record files.
GREEN_RAW = struct(
    VendorID=INT,
    lpep_pickup_datetime=TIME,
    lpep_dropoff_datetime=TIME,
    store_and_fwd_flag=TEXT,
    RatecodeID=INT,
    PULocationID=INT,
    DOLocationID=INT,
    passenger_count=DOUBLE,
    trip_distance=DOUBLE,
    fare_amount=DOUBLE,
    extra=DOUBLE,
    mta_tax=DOUBLE,
    tip_amount=DOUBLE,
    tolls_amount=DOUBLE,
    ehail_fee=DOUBLE,
    improvement_surcharge=DOUBLE,
    total_amount=DOUBLE,
    congestion_surcharge=DOUBLE,
    payment_type=INT,
    trip_type=INT,
)

YELLOW_RAW = struct(
    VendorID=INT,
    tpep_pickup_datetime=TIME,
    tpep_dropoff_datetime=TIME,
    passenger_count=DOUBLE,
    trip_distance=DOUBLE,
    RatecodeID=INT,
    store_and_fwd_flag=TEXT,
    PULocationID=INT,
    DOLocationID=INT,
    payment_type=INT,
    fare_amount=DOUBLE,
    extra=DOUBLE,
    mta_tax=DOUBLE,
    tip_amount=DOUBLE,
    tolls_amount=DOUBLE,
    improvement_surcharge=DOUBLE,
    total_amount=DOUBLE,
    congestion_surcharge=DOUBLE,
)

FHV_RAW = struct(
    dispatching_base_num=TEXT,
    pickup_datetime=TIME,
    dropoff_datetime=TIME,
    pulocationid=INT,
    dolocationid=INT,
    sr_flag=INT,
)

ZONES = struct(LocationID=INT, Borough=TEXT, Zone=TEXT, service_zone=TEXT)

RIDE = struct(PULocationID=INT, DOLocationID=INT, trip_distance=DOUBLE, total_amount=DOUBLE, tpep_pickup_datetime=LONG)

GREEN_EVENT = struct(
    PULocationID=INT,
    DOLocationID=INT,
    passenger_count=DOUBLE,
    trip_distance=DOUBLE,
    tip_amount=DOUBLE,
    total_amount=DOUBLE,
    lpep_pickup_datetime=TEXT,
    lpep_dropoff_datetime=TEXT,
)

SCHEMAS = {"green": GREEN_RAW, "yellow": YELLOW_RAW, "fhv": FHV_RAW}
PICKUP_PREFIX = {"green": "lpep", "yellow": "tpep"}


def get_schema(taxi_type: str) -> T.StructType:
    """Schema of one service; ValueError for a name that is not known."""
    try:
        return SCHEMAS[taxi_type.strip().lower()]
    except KeyError:
        raise ValueError(f"unknown taxi type {taxi_type!r}, expected one of {sorted(SCHEMAS)}") from None
