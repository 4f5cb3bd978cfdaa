"""Silver to gold: one trips table for all feeds, and its monthly aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stratalake.fixed import OTHER_PROVIDER, PROVIDERS, YEAR_MONTH
from stratalake.operators.aggregate import monthly_aggregate, monthly_aggregate_ranged
from stratalake.operators.conform import code_label, conform, typed_null, union_all
from stratalake.operators.dates import with_year_month
from stratalake.sources.layout import clustered, rebalanced
from stratalake.sources.tables import publish_partitions, read_partitions

PLACES = {"pulocationid": "pulocationid", "dolocationid": "dolocationid"}
# Order of the rows inside the published files, and columns that both tables are clustered by.
SORTED_BY = ["pickup_datetime", "pulocationid", "dolocationid", "service_type"]
MONTHLY_SORTED_BY = ["service_type", "provider", "pulocationid", "dolocationid"]


def _layout(pickup: str, dropoff: str, distance, amount, service: str, provider=None) -> dict:
    return {
        "pickup_datetime": pickup,
        "dropoff_datetime": dropoff,
        **PLACES,
        "trip_distance": distance,
        "total_amount": amount,
        "service_type": F.lit(service),
        "provider": F.lit(service) if provider is None else provider,
    }


def gold_layouts() -> dict[str, dict]:
    """How each silver feed maps to the trips table."""
    return {
        "yellow": _layout(
            "tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance", ("total_amount", "double"), "yellow"
        ),
        "green": _layout("lpep_pickup_datetime", "lpep_dropoff_datetime", "trip_distance", "total_amount", "green"),
        "fhv": _layout("pickup_datetime", "dropoff_datetime", typed_null("double"), typed_null("double"), "fhv"),
        "hvfhv": _layout(
            "pickup_datetime",
            "dropoff_datetime",
            "trip_miles",
            "base_passenger_fare",
            "hvfhv",
            code_label(F.col("hvfhs_license_num"), PROVIDERS, OTHER_PROVIDER),
        ),
    }


def to_gold(silver: Mapping[str, DataFrame]) -> DataFrame:
    """All given feeds in one layout, with the month of the pickup."""
    layouts = gold_layouts()
    trips = union_all(*[conform(df, layouts[name]) for name, df in silver.items()])
    return with_year_month(trips, "pickup_datetime")


def gold_trips_schema(timestamp: str = "timestamp") -> T.StructType:
    return T.StructType.fromDDL(
        f"pickup_datetime {timestamp}, dropoff_datetime {timestamp}, pulocationid bigint, dolocationid bigint, "
        "trip_distance double, total_amount double, service_type string, provider string, ano_mes string"
    )


def publish_gold(
    spark: SparkSession,
    trips: DataFrame,
    trips_path: str,
    monthly_path: str,
    months: Sequence[str] | None = None,
    scale: int | None = None,
    optimize: bool = False,
    files: int | None = None,
    by_month: bool = False,
) -> None:
    """Publish the given trips by month, then aggregate what was published.

    The aggregate is grouped by month, so rebuilding only the ``months`` that
    changed is exact; ``trips`` then holds all trips of those months. With
    ``optimize`` both tables are clustered, month by month, by the columns they
    are filtered on, in ``files`` files or as many as the session has shuffle
    partitions. ``by_month`` says that ``trips`` are read from tables with
    months as partitions: their files then become files of the gold table
    without a shuffle.
    """
    if optimize:
        layout = clustered(trips, SORTED_BY, files, lead=[YEAR_MONTH])
    else:
        layout = (trips if by_month else rebalanced(trips, YEAR_MONTH)).sortWithinPartitions(YEAR_MONTH, *SORTED_BY)
    publish_partitions(layout, trips_path, YEAR_MONTH)
    published = read_partitions(spark, trips_path, YEAR_MONTH, trips.schema, months)
    monthly = monthly_aggregate_ranged(published, scale)
    publish_partitions(monthly, monthly_path, YEAR_MONTH)
    if optimize:
        rows = read_partitions(spark, monthly_path, YEAR_MONTH, monthly.schema, months)
        publish_partitions(clustered(rows, MONTHLY_SORTED_BY, files, lead=[YEAR_MONTH]), monthly_path, YEAR_MONTH, same_rows=True)


def read_gold_trips(spark: SparkSession, path: str, timestamp: str = "timestamp") -> DataFrame:
    return read_partitions(spark, path, YEAR_MONTH, gold_trips_schema(timestamp))


def read_gold_monthly(spark: SparkSession, path: str, timestamp: str = "timestamp") -> DataFrame:
    """The published monthly aggregate."""
    nothing = spark.createDataFrame([], gold_trips_schema(timestamp))
    return read_partitions(spark, path, YEAR_MONTH, monthly_aggregate(nothing).schema)
