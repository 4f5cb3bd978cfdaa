"""Landing files: listing, reading despite type drift, and a batch ledger."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stratalake.functions.names import lookup
from stratalake.operators.conform import union_all
from stratalake.operators.schema import enforce_schema
from stratalake.sources.storage import compressed
from stratalake.sources.tables import LEVEL, publish, version_dir, versions

# The columns of Spark's own file listing source; ``content`` is never read here.
LISTING = "path string, modificationTime timestamp, length bigint, content binary"
FOOTER_THREADS = 8


def read_parquet(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Files or whole directories, with a declared or the files' own schema."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*([paths] if isinstance(paths, str) else paths))


def wanted(listing: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Listed files whose path matches none of the ``exclude`` patterns."""
    for pattern in exclude:
        listing = listing.filter(~F.col("path").rlike(pattern))
    return listing


def list_files(spark: SparkSession, landing: str, exclude: Sequence[str] = (), glob: str = "*.parquet") -> DataFrame:
    """Path, modification time and length of the files below ``landing``."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(landing)
        .select("path", "modificationTime", "length")
    )
    return wanted(listing, exclude)


def _by_schema(spark: SparkSession, paths: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """The files by the schema in their own footer, each read once on a few driver threads."""
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    with ThreadPoolExecutor(FOOTER_THREADS) as pool:
        for path, schema in zip(paths, pool.map(lambda p: spark.read.parquet(p).schema, paths)):
            groups.setdefault(schema.json(), (schema, []))[1].append(path)
    return list(groups.values())


def load_files(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType | None, on_missing: str = "error"
) -> DataFrame:
    """The files as one DataFrame of the declared schema, whatever numeric
    types the single files carry: one scan for each schema found.

    What a file gives does not depend on the files it is loaded with; a file
    that lacks a declared column is named in the error, or gives nulls with
    ``on_missing="null"``.
    """
    groups = _by_schema(spark, sorted(paths))
    if schema is None:
        return union_all(*[read_parquet(spark, files, found) for found, files in groups])
    if on_missing == "error":
        for found, files in groups:
            if absent := [c for c in schema.names if lookup(found.names, c) is None]:
                raise AnalysisException(f"{files[0]} lacks the declared columns {absent}")
    return union_all(*[enforce_schema(read_parquet(spark, files, found), schema, on_missing) for found, files in groups])


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """Files ingested so far, one row per file: ``path``, ``load_id``."""
    loads = versions(spark, ledger)
    if not loads:
        return spark.createDataFrame([], "path string, load_id bigint")
    df = spark.read.schema(f"path string, {LEVEL} bigint").option("basePath", ledger).parquet(
        *[version_dir(ledger, n) for n in loads]
    )
    return df.select("path", F.col(LEVEL).alias("load_id"))


def pending_files(spark: SparkSession, landing: str, ledger: str, exclude: Sequence[str] = ()) -> DataFrame:
    """Listed files the ledger does not have."""
    return list_files(spark, landing, exclude).join(read_ledger(spark, ledger), "path", "left_anti")


def ingest_files(
    spark: SparkSession,
    landing: str,
    bronze: str,
    ledger: str,
    schema: T.StructType | None = None,
    exclude: Sequence[str] = (),
    max_files: int = 1000,
    on_missing: str = "error",
) -> int:
    """Ingest all pending files, ``max_files`` per load; returns their number.

    A load is written under its own number and becomes visible only when the
    ledger entry of that number is complete, so a crash at any point neither
    loses nor doubles rows: the next run writes the same load again.
    """
    # The names arrive in pieces, so the driver holds one load's worth of them.
    pending = pending_files(spark, landing, ledger, exclude).select("path").orderBy("path").toLocalIterator()
    done = 0
    while batch := [row.path for row in islice(pending, max_files)]:
        loads = versions(spark, ledger)
        load_id = loads[-1] + 1 if loads else 1
        compressed(load_files(spark, batch, schema, on_missing)).mode("overwrite").parquet(version_dir(bronze, load_id))
        publish(spark.createDataFrame([(p,) for p in batch], "path string"), ledger, version=load_id)
        done += len(batch)
    return done


def read_bronze(
    spark: SparkSession, bronze: str, ledger: str, schema: T.StructType, after: int = 0
) -> DataFrame:
    """All loads the ledger confirms, or those numbered higher than ``after``."""
    paths = [version_dir(bronze, n) for n in versions(spark, ledger) if n > after]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", bronze).parquet(*paths).select(*schema.names)


def append_parquet(df: DataFrame, path: str, max_records_per_file: int = 0) -> None:
    """Plain append, without exactly-once bookkeeping."""
    df.write.mode("append").option("maxRecordsPerFile", max_records_per_file).parquet(path)
