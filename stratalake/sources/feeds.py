"""The four trip feeds: declared schema, keys, clock column, clustering."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The declared columns and types of the feeds, in file order.
YELLOW = """
    VendorID bigint, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp,
    passenger_count bigint, trip_distance double, RatecodeID bigint, store_and_fwd_flag string,
    PULocationID bigint, DOLocationID bigint, payment_type bigint, fare_amount string, extra double,
    mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double,
    total_amount double, congestion_surcharge double, Airport_fee double
"""
GREEN = """
    VendorID bigint, lpep_pickup_datetime timestamp, lpep_dropoff_datetime timestamp,
    store_and_fwd_flag string, RatecodeID bigint, PULocationID bigint, DOLocationID bigint,
    passenger_count bigint, trip_distance double, fare_amount double, extra double, mta_tax double,
    tip_amount double, tolls_amount double, ehail_fee double, improvement_surcharge double,
    total_amount double, payment_type bigint, trip_type bigint, congestion_surcharge double
"""
FHV = """
    dispatching_base_num string, pickup_datetime timestamp, dropOff_datetime timestamp,
    PUlocationID bigint, DOlocationID bigint, SR_Flag bigint, Affiliated_base_number string
"""
HVFHV = """
    hvfhs_license_num string, dispatching_base_num string, originating_base_num string,
    request_datetime timestamp, on_scene_datetime timestamp, pickup_datetime timestamp,
    dropoff_datetime timestamp, PULocationID bigint, DOLocationID bigint, trip_miles double,
    trip_time bigint, base_passenger_fare double, tolls double, bcf double, sales_tax double,
    congestion_surcharge double, airport_fee double, tips double, driver_pay double,
    shared_request_flag string, shared_match_flag string, access_a_ride_flag string,
    wav_request_flag string, wav_match_flag string
"""


TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


@dataclass(frozen=True)
class Feed:
    """``keys`` and the column names below are those of the silver layer."""

    name: str
    columns: str
    keys: tuple[str, ...]
    pickup: str
    cluster_by: tuple[str, ...]

    @property
    def schema(self) -> T.StructType:
        pairs = [column.split() for column in self.columns.split(",")]
        return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])

    def with_ntz(self) -> "Feed":
        """The same feed with wall-clock (zone-free) timestamps."""
        columns = self.columns.replace(" timestamp", " timestamp_ntz")
        return Feed(self.name, columns, self.keys, self.pickup, self.cluster_by)


# Keys, clock and clustering columns per feed.
FEEDS = {
    feed.name: feed
    for feed in (
        Feed(
            "yellow",
            YELLOW,
            ("vendorid", "tpep_pickup_datetime"),
            "tpep_pickup_datetime",
            ("tpep_pickup_datetime", "tpep_dropoff_datetime", "pulocationid", "dolocationid"),
        ),
        Feed(
            "green",
            GREEN,
            ("vendorid", "lpep_pickup_datetime"),
            "lpep_pickup_datetime",
            ("lpep_pickup_datetime", "lpep_dropoff_datetime", "pulocationid", "dolocationid"),
        ),
        Feed(
            "fhv",
            FHV,
            ("dispatching_base_num", "pickup_datetime"),
            "pickup_datetime",
            ("pickup_datetime", "pulocationid", "dolocationid"),
        ),
        Feed(
            "hvfhv",
            HVFHV,
            ("hvfhs_license_num", "pickup_datetime"),
            "pickup_datetime",
            ("pickup_datetime", "pulocationid", "dolocationid"),
        ),
    )
}
