"""Published Parquet tables.

Spark cannot overwrite files that the same plan reads, so each write goes to a
new directory ``table_version=<n>`` below the table path and counts once its ``_SUCCESS``
marker is there. A lost executor or driver leaves at most an unmarked
directory, which the next write of that number replaces.

``publish`` replaces the whole table. ``publish_partitions`` writes only the
partitions present in the data, and then a small table that names the files of
every partition: a write counts once that is complete. Readers look at the
newest of these small tables alone, so the work of opening a table does not
grow with the number of its versions; all but the last two are removed. A
partition without rows is a row of the small table, not a directory.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from stratalake.functions.names import column, fresh_name, quoted, require_columns
from stratalake.operators.dedup import keep_one
from stratalake.operators.upsert import same_keys, upsert
from stratalake.sources.storage import compressed, matching, remove, shared_dir, sized

# The directory level of the versions; no table may have a column of this name.
LEVEL = "table_version"
PREFIX = f"{LEVEL}="
# How Spark writes a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# Where a table of partitions keeps the small tables that name its files.
PARTS = "_parts"
PART_FILES = "partition string, changed bigint, file string, bytes bigint"
# Keys of a source, at most, that become a filter on the files.
FEW_KEYS = 1000


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions, oldest first."""
    return sorted(int(level[len(PREFIX):]) for level, _ in matching(spark, path, f"{PREFIX}*/_SUCCESS"))


def table_exists(spark: SparkSession, path: str) -> bool:
    return bool(versions(spark, path))


def version_dir(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/{PREFIX}{version:09d}"


def _next(spark: SparkSession, path: str) -> int:
    done = versions(spark, path)
    return done[-1] + 1 if done else 1


def publish(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    max_records_per_file: int = 0,
    version: int | None = None,
    bloom: Sequence[str] = (),
) -> int:
    """Write ``df`` as the new content of the table; returns the version.

    A ``version`` given by the caller makes the write idempotent: if it is
    complete already, nothing is written. The columns in ``bloom`` get a Bloom
    filter in every row group, for point look-ups.
    """
    spark = df.sparkSession
    number = _next(spark, path) if version is None else version
    if version is not None and version in versions(spark, path):
        return number
    _write(df, path, partition_by, max_records_per_file, number, bloom)
    return number


def _write(df: DataFrame, path: str, partition_by: Sequence[str], max_records_per_file: int, number: int, bloom: Sequence[str]) -> None:
    if LEVEL in (c.lower() for c in df.columns):
        raise AnalysisException(f"A published table cannot have a column {LEVEL!r}")
    writer = compressed(df).mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
    for name in require_columns(df, bloom):
        # The filter takes the size that the number of values in the row group calls for.
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true").option(f"parquet.bloom.filter.adaptive.enabled#{name}", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(version_dir(path, number))


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, version: int | None = None) -> DataFrame:
    """The newest complete version of a table written by ``publish``."""
    done = versions(spark, path)
    if not done or (version is not None and version not in done):
        raise AnalysisException(f"No published version of {path} (asked for {version}, found {done})")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(version_dir(path, done[-1] if version is None else version))


def parts_path(path: str) -> str:
    return f"{path.rstrip('/')}/{PARTS}"


def newest_parts(spark: SparkSession, path: str) -> int:
    """The number of the newest complete write of a table of partitions, 0 if there is none."""
    return max(versions(spark, parts_path(path)), default=0)


def part_files(spark: SparkSession, path: str) -> DataFrame:
    """``partition, changed, file, bytes``: the files of every partition below the table path, and the version in which its
    rows last changed. A partition that lost all rows has one row without a file."""
    number = newest_parts(spark, path)
    if not number:
        return spark.createDataFrame([], PART_FILES)
    return spark.read.schema(PART_FILES).parquet(version_dir(parts_path(path), number))


def _value(directory: str, partition: str) -> str | None:
    """The partition value a directory name stands for."""
    text = unquote(directory[len(partition) + 1:])
    return None if text == NULL_PARTITION else text


def _texts(values: Iterable[object]) -> list[tuple[str | None]]:
    return [(None if value is None else str(value),) for value in set(values)]


def _of_partitions(spark: SparkSession, rows: DataFrame, values: Iterable[object], how: str) -> DataFrame:
    wanted = spark.createDataFrame(_texts(values), "value string")
    return rows.join(wanted, rows["partition"].eqNullSafe(wanted["value"]), how)


def partition_values(spark: SparkSession, path: str, partition: str, version: int) -> list[str | None]:
    """Values of the partitions whose rows one version was the last to change."""
    rows = part_files(spark, path).filter(F.col("changed") == version).select("partition").distinct()
    return [row[0] for row in rows.orderBy("partition").collect()]


def changed_partitions(spark: SparkSession, path: str, after: int) -> list[str | None]:
    """Values of the partitions whose rows changed in a version later than ``after``."""
    rows = part_files(spark, path).filter(F.col("changed") > after).select("partition").distinct()
    return [row[0] for row in rows.orderBy("partition").collect()]


def _record(spark: SparkSession, path: str, number: int, rows: DataFrame) -> None:
    """Make a write count: publish its small table and remove those that no reader starts from any more."""
    publish(rows.select("partition", "changed", "file", "bytes").coalesce(1), parts_path(path), version=number)
    for old in versions(spark, parts_path(path))[:-2]:
        remove(spark, version_dir(parts_path(path), old))


def _written_files(spark: SparkSession, path: str, partition: str, number: int) -> list[tuple[str | None, str, int]]:
    """Partition value, file and bytes of what one version wrote."""
    level = f"{PREFIX}{number:09d}"
    found = sized(spark, version_dir(path, number), f"{partition}=*/*.parquet")
    return [(_value(name, partition), f"{level}/{name}/{file}", size) for (name, file), size in found]


def publish_partitions(
    df: DataFrame,
    path: str,
    partition: str,
    max_records_per_file: int = 0,
    version: int | None = None,
    rewritten: Iterable[object] = (),
    bloom: Sequence[str] = (),
    same_rows: bool = False,
) -> int:
    """Write the partitions present in ``df`` and those in ``rewritten``, values that may have no rows left; all others keep
    their content. ``version`` and ``bloom`` as in ``publish``. ``same_rows`` says that the rows are those the partitions
    have, laid out anew, so the partitions do not count as changed."""
    spark = df.sparkSession
    newest = newest_parts(spark, path)
    number = newest + 1 if version is None else version
    if version is not None and version <= newest:
        return number
    _write(df, path, [partition], max_records_per_file, number, bloom)
    files = _written_files(spark, path, partition, number)
    touched = {value for value, _, _ in files} | {value for (value,) in _texts(rewritten)}
    empty = touched - {value for value, _, _ in files}
    new = [(value, number, file, size) for value, file, size in files] + [(value, number, None, None) for value in empty]
    known = part_files(spark, path)
    rows = _aged(known, files) if same_rows else spark.createDataFrame(new, PART_FILES)
    _record(spark, path, number, _of_partitions(spark, known, touched, "left_anti").unionByName(rows))
    return number


def _aged(known: DataFrame, files: Sequence[tuple[str | None, str, int]]) -> DataFrame:
    """Rows of the small table for new files with the old rows of their partitions."""
    new = known.sparkSession.createDataFrame(files, "value string, file string, bytes bigint")
    ages = known.groupBy("partition").agg(F.max("changed").alias("changed"))
    return new.join(ages, new["value"].eqNullSafe(ages["partition"])).select("partition", "changed", "file", "bytes")


def _read_files(spark: SparkSession, path: str, schema: T.StructType, files: Sequence[str]) -> DataFrame:
    if not files:
        return spark.createDataFrame([], schema)
    base = path.rstrip("/")
    # The version is a directory level too; selecting the schema's columns leaves it out.
    return spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{file}" for file in files])


def read_partitions(
    spark: SparkSession, path: str, partition: str, schema: T.StructType, only: Iterable[object] | None = None
) -> DataFrame:
    """The content of every partition, or of those in ``only``."""
    rows = part_files(spark, path).filter("file is not null")
    if only is not None:
        rows = _of_partitions(spark, rows, only, "left_semi")
    df = _read_files(spark, path, schema, [row.file for row in rows.select("file").orderBy("file").collect()])
    return df.select(*[column(c) for c in schema.names])


def compact_partitions(
    spark: SparkSession,
    path: str,
    partition: str,
    schema: T.StructType,
    target: int = 128 << 20,
    small: int | None = None,
    only: Iterable[object] | None = None,
    max_files: int = 10_000,
    bloom: Sequence[str] = (),
) -> int:
    """Rewrite files with fewer than ``small`` bytes (half of ``target``) together, the others stay as they are; returns the
    number of files that are gone.

    The plan comes from the sizes that the table keeps of its files: in order
    of size, files of a partition fill bins of ``target`` bytes, and bins of two
    files and more become one file each. ``max_files`` are read per write; a
    write that is lost changes nothing, and the next run makes the plan anew.
    """
    gone = 0
    while True:
        rows = part_files(spark, path).filter("file is not null")
        if only is not None:
            rows = _of_partitions(spark, rows, only, "left_semi")
        own = Window.partitionBy("partition").orderBy("bytes", "file")
        before = F.coalesce(F.sum("bytes").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        binned = rows.filter(F.col("bytes") < (target // 2 if small is None else small)).withColumn("bin", F.floor(before / F.lit(target)))
        full = binned.groupBy("partition", "bin").agg(F.sort_array(F.collect_list("file")).alias("files")).filter(F.size("files") > 1)
        bins, count = [], 0
        for row in full.orderBy("partition", "bin").toLocalIterator():
            if bins and count + len(row.files) > max_files:
                break
            bins.append(row)
            count += len(row.files)
        if not bins:
            return gone
        names = [(row.partition, file.rsplit("/", 1)[1], i) for i, row in enumerate(bins) for file in row.files]
        plan = spark.createDataFrame(names, "value string, name string, bin int").alias("p")
        old = _read_files(spark, path, schema, [file for row in bins for file in row.files])
        name, place = fresh_name(old, "name"), fresh_name(old, "bin")
        old = old.select(*[column(c) for c in schema.names], F.element_at(F.split(F.col("_metadata.file_name"), "/"), -1).alias(name)).alias("r")
        same = F.col(f"r.{quoted(partition)}").cast("string").eqNullSafe(F.col("p.value")) & (F.col(f"r.{name}") == F.col("p.name"))
        joined = old.join(plan, same).select("r.*", F.col("p.bin").alias(place)).drop(name)
        number = newest_parts(spark, path) + 1
        _write(joined.repartitionById(len(bins), F.col(place)).drop(place), path, [partition], 0, number, bloom)
        known = part_files(spark, path)
        taken = spark.createDataFrame([(file,) for row in bins for file in row.files], "file string")
        stays = known.join(taken, "file", "left_anti")
        files = _written_files(spark, path, partition, number)
        _record(spark, path, number, stays.unionByName(_aged(known, files)))
        gone += count - len(files)


def upsert_partitions(
    source: DataFrame,
    path: str,
    partition: str,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    source_unique: bool = False,
    touched_by: DataFrame | None = None,
    max_records_per_file: int = 0,
    derived_from: str | None = None,
    bloom: bool = False,
    by_partition: bool = False,
) -> int:
    """Upsert into a partitioned table, rewriting only the touched partitions.

    A key stays in its partition when the partition column is a key, or is
    derived from the key ``derived_from``. Otherwise the partitions where the
    table has keys of the source are looked up and rewritten too, so a key that
    moves leaves its old partition; the source is then written to the shared
    folder first, so that it is computed once. With ``bloom``, files get Bloom
    filters on the keys, and a source of few keys reads only row groups that
    may have one of them. Only the names of the touched partitions come to the
    driver; they are taken from ``touched_by`` if given, a cheaper DataFrame
    with the same partition values as ``source``. ``by_partition`` says that
    rows of a partition lie in few tasks already: the first write then deals
    out nothing.
    """
    spark = source.sparkSession
    (partition,) = require_columns(source, [partition])
    keys = require_columns(source, keys)
    fixed = partition if derived_from is None else require_columns(source, [derived_from])[0]
    if derived_from is not None and fixed not in keys:
        raise AnalysisException(f"The partition can only be derived from one of the keys {list(keys)}, not {fixed!r}")
    filters = [k for k in keys if k != partition] if bloom else []
    gone: set[object] = set()
    first = not newest_parts(spark, path)
    if first:
        merged = source if source_unique else keep_one(source, keys, list(order_by))
    else:
        if fixed not in keys:
            staged = shared_dir(spark, "upsert-source")
            source.write.parquet(staged)
            source = spark.read.schema(source.schema).parquet(staged)
        origin = source if touched_by is None else touched_by
        touched = {row[0] for row in origin.select(column(partition)).distinct().collect()}
        if fixed not in keys:
            known = read_partitions(spark, path, partition, source.schema)
            gone = {row[0] for row in rows_with_keys(known, source, keys).select(column(partition)).distinct().collect()}
            touched |= gone
        target = read_partitions(spark, path, partition, source.schema, touched)
        merged = upsert(target, source, keys, order_by, source_unique)
    # Rebalancing evens out file sizes and splits a partition that is too big for one task.
    balanced = merged if first and source_unique and by_partition else merged.hint("rebalance", column(partition))
    return publish_partitions(balanced, path, partition, max_records_per_file, rewritten=gone, bloom=filters)


def rows_with_keys(table: DataFrame, source: DataFrame, keys: Sequence[str], limit: int = FEW_KEYS) -> DataFrame:
    """Rows of the table that have a key of the source; null keys match each other.

    If the source has ``limit`` keys at most, their values become a filter that
    Parquet checks against statistics, dictionaries and Bloom filters of each
    row group. Beyond that, the join alone decides, with Spark's own runtime
    Bloom filter where that pays.
    """
    wanted = source.select(*map(column, keys)).distinct()
    few = wanted.limit(limit + 1).collect()
    rows = table
    if len(few) <= limit:
        for i, key in enumerate(keys):
            values = {row[i] for row in few}
            test = column(key).isin([v for v in values if v is not None])
            rows = rows.filter(test | column(key).isNull() if None in values else test)
    return rows.alias("t").join(wanted.alias("s"), same_keys("t", "s", keys), "left_semi")


def register_views(spark: SparkSession, tables: dict[str, DataFrame | str]) -> None:
    """Make layers available to SQL: name -> DataFrame or published path."""
    for name, table in tables.items():
        df = read_table(spark, table) if isinstance(table, str) else table
        df.createOrReplaceTempView(name)
