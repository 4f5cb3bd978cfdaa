import os
from datetime import datetime
from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from stratalake.functions.bits import bisected, interleaved, spread
from stratalake.sources import files, layout, storage, tables


def parts(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_publish_and_read(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not tables.table_exists(spark, path)
    with pytest.raises(AnalysisException):
        tables.read_table(spark, path)
    assert tables.publish(spark.range(3), path) == 1
    # Overwriting a table with rows that come from itself.
    assert tables.publish(tables.read_table(spark, path).filter("id > 0"), path) == 2
    assert rows(tables.read_table(spark, path)) == [(1,), (2,)]
    assert rows(tables.read_table(spark, path, version=1)) == [(0,), (1,), (2,)]
    # A version that was given by the caller is written once.
    assert tables.publish(spark.range(9), path, version=2) == 2
    assert tables.read_table(spark, path).count() == 2


def test_unfinished_versions_do_not_count(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.publish(spark.range(3), path)
    spark.range(9).write.parquet(tables.version_dir(path, 2))
    os.remove(os.path.join(tables.version_dir(path, 2), "_SUCCESS"))
    assert tables.versions(spark, path) == [1] and tables.read_table(spark, path).count() == 3
    assert tables.publish(spark.range(5), path) == 2
    assert tables.read_table(spark, path).count() == 5


def test_partition_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    ddl = "k int, v string, m string"
    first = spark.createDataFrame([(1, "a", "202301"), (2, "b", "202302"), (3, "c", "a/b %"), (4, "d", None)], ddl)
    second = spark.createDataFrame([(2, "B", "202302"), (5, "e", "202303"), (4, "D", None), (3, "C", "a/b %")], ddl)
    tables.upsert_partitions(first, path, "m", ["k"])
    tables.upsert_partitions(second, path, "m", ["k"], touched_by=second.select("m"))
    out = tables.read_partitions(spark, path, "m", first.schema)
    assert rows(out) == sorted(
        [(1, "a", "202301"), (2, "B", "202302"), (3, "C", "a/b %"), (4, "D", None), (5, "e", "202303")], key=repr
    )
    assert set(tables.partition_values(spark, path, "m", 2)) == {"202302", "202303", "a/b %", None}
    some = tables.read_partitions(spark, path, "m", first.schema, ["202301", None])
    assert rows(some) == sorted([(1, "a", "202301"), (4, "D", None)], key=repr)
    assert tables.read_partitions(spark, path, "m", first.schema, ["x"]).count() == 0


def test_keys_that_move_leave_their_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    ddl = "k int, v string, m string"
    first = spark.createDataFrame([(1, "a", "202401"), (2, "b", "202402"), (3, "c", "a/b %"), (None, "d", None), (5, "e", "202405")], ddl)
    tables.upsert_partitions(first, path, "m", ["k"])
    spark.range(9).write.parquet(f"{tables.version_dir(path, 2)}/m=202405")  # left by a write that was lost
    second = spark.createDataFrame([(1, "A", "202402"), (3, "C", "202403"), (None, "D", "202403")], ddl)
    tables.upsert_partitions(second, path, "m", ["k"])
    want = [(1, "A", "202402"), (2, "b", "202402"), (3, "C", "202403"), (None, "D", "202403"), (5, "e", "202405")]
    assert rows(tables.read_partitions(spark, path, "m", first.schema)) == sorted(want, key=repr)
    assert set(tables.partition_values(spark, path, "m", 2)) == {"202401", "202402", "202403", "a/b %", None}
    back = spark.createDataFrame([(1, "x", "202401")], ddl)
    tables.upsert_partitions(back, path, "m", ["k"])
    assert rows(tables.read_partitions(spark, path, "m", first.schema).filter("k = 1")) == [(1, "x", "202401")]
    with pytest.raises(AnalysisException):
        tables.upsert_partitions(back, path, "m", ["k"], derived_from="v")


def test_views(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.publish(spark.range(4), path)
    tables.register_views(spark, {"by_path": path, "by_frame": spark.range(2)})
    assert spark.sql("select (select count(*) from by_path) + (select count(*) from by_frame) n").first().n == 6


def session(**settings):
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key.replace(".", "_"), default))
    return SimpleNamespace(conf=conf)


def test_shared_dir(spark):
    one, two = (storage.shared_dir(session(spark_checkpoint_dir="hdfs://lake/tmp/"), "x") for _ in range(2))
    assert one != two and one.startswith("hdfs://lake/tmp/x-")
    assert storage.shared_dir(session(spark_sql_warehouse_dir="s3a://lake/w"), "x").startswith("s3a://lake/w/x-")
    assert storage.shared_dir(spark, "x") != storage.shared_dir(spark, "x")


def test_bits(spark):
    assert [spread(n, 2, 0) for n in range(4)] == [0, 1, 4, 5] and spread(3, 3, 1) == 0b10010
    bounds = [10, 20, 20.5, 30]
    df = spark.createDataFrame([(v,) for v in (None, 9.9, 10.0, 20.2, 29.0, 30.0, 99.0)], "v double")
    assert [r[0] for r in df.select(bisected(F.col("v"), bounds, range(5))).collect()] == [0, 0, 1, 2, 3, 4, 4]
    pairs = spark.range(64).select((F.col("id") % 8).alias("x"), F.floor(F.col("id") / 8).alias("y"))
    steps = [i + 0.5 for i in range(7)]
    for r in pairs.withColumn("z", interleaved([F.col("x"), F.col("y")], [steps, steps], 3)).collect():
        assert r.z == sum(((r.x >> i) & 1) << (2 * i) | ((r.y >> i) & 1) << (2 * i + 1) for i in range(3))
    with pytest.raises(ValueError):
        interleaved([F.col("x")] * 13, [steps] * 13, 5)


def test_clustering_keeps_rows_and_narrows_files(spark, tmp_path):
    import pyarrow.parquet as pq

    path = str(tmp_path / "z")
    df = spark.range(20000).select(
        (F.col("id") * 7919 % 1000).alias("a"),
        F.concat(F.lit("k"), F.lpad((F.col("id") * 104729 % 997).cast("string"), 3, "0")).alias("s"),
        (F.timestamp_seconds(F.col("id") * 6151 % 86400)).cast("timestamp_ntz").alias("t"),
        "id",
    )
    layout.cluster_write(df, path, ["a", "s"], files=16)
    assert rows(tables.read_table(spark, path).agg(F.count("*"), F.sum("id"))) == [(20000, sum(range(20000)))]
    files_ = parts(path)
    assert len(files_) == 16

    def touched(column, value):
        hit = 0
        for f in files_:
            meta = pq.ParquetFile(f).metadata
            i = [meta.schema.column(c).name for c in range(meta.num_columns)].index(column)
            stats = meta.row_group(0).column(i).statistics
            hit += stats.min <= value <= stats.max
        return hit

    assert touched("a", 500) <= 6 and touched("s", "k500") <= 6
    timed = layout.clustered(df, ["t", "a"], files=4)
    assert timed.columns == df.columns and timed.count() == 20000


def test_files_of_a_text_column_with_a_long_common_head(spark, tmp_path):
    """A point filter on the name reads a few of the 16 files, though all names begin alike."""
    import pyarrow.parquet as pq

    path = str(tmp_path / "names")
    df = spark.range(0, 30000, 1, 5).select(F.concat(F.lit("Customer#000"), F.lpad((F.col("id") * 7919 % 30011).cast("string"), 9, "0")).alias("name"), (F.col("id") % 977).alias("b"))
    for number in (1, 2):
        layout.cluster_write(df, path, ["name", "b"], files=16)
    of = lambda n: [pq.ParquetFile(f).metadata for f in parts(tables.version_dir(path, n))]
    layouts = [sorted((m.num_rows, m.row_group(0).column(0).statistics.min, m.row_group(0).column(0).statistics.max) for m in of(n)) for n in (1, 2)]
    assert layouts[0] == layouts[1] and len(layouts[0]) == 16  # the same on every run
    for wanted in ("Customer#000000000500", "Customer#000000015000", "Customer#000000029999"):
        assert sum(low <= wanted <= high for _, low, high in layouts[0]) <= 6
    assert max(n for n, _, _ in layouts[0]) < 2 * 30000 / 16
    alone = layout.clustered(df, ["name"], files=16).groupBy(F.spark_partition_id().alias("p")).agg(F.min("name").alias("low"), F.max("name").alias("high"))
    assert alone.filter("low <= 'Customer#000000015000' and 'Customer#000000015000' <= high").count() == 1


def test_hilbert_curve():
    from stratalake.functions.bits import hilbert_index

    for n, bits in ((1, 4), (2, 3), (3, 2)):
        cells = [tuple(i >> (bits * k) & (1 << bits) - 1 for k in range(n)) for i in range(1 << (n * bits))]
        line = sorted(cells, key=lambda c: hilbert_index(c, bits))
        assert sorted(hilbert_index(c, bits) for c in cells) == list(range(len(cells)))
        assert all(sum(abs(a - b) for a, b in zip(x, y)) == 1 for x, y in zip(line, line[1:]))


def test_cut_cells():
    assert layout.cut_cells([(i, 10) for i in range(16)], 40) == [(i // 4, 1) for i in range(16)]
    assert layout.cut_cells([(i, 9 + i % 3) for i in range(16)], 40) == [(i // 4, 1) for i in range(16)]  # ends at blocks
    assert layout.cut_cells([(0, 10), (1, 95), (2, 5), (3, 5)], 20) == [(0, 1), (1, 5), (6, 1), (6, 1)]
    assert layout.cut_cells([(0, 1)], 100) == [(0, 1)]


def test_lead_columns_come_before_the_curve(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") % 5 > 0, (F.col("id") % 5).cast("string")).alias("m"), (F.col("id") * 31 % 101).alias("a"))
    out = layout.clustered(df, ["a", "id"], files=10, lead=["m"])
    assert out.columns == df.columns and rows(out) == rows(df)
    per = out.groupBy(F.spark_partition_id().alias("p")).agg(F.count_distinct("m").alias("n"), F.count("*").alias("rows")).collect()
    assert all(r.n <= 1 for r in per) and len(per) == 10


def test_cluster_bounds(spark):
    df = spark.range(0, 10000, 1, 6).select("id", F.lit(None).cast("int").alias("none"), F.lit(3).alias("one"))
    bounds = layout.cluster_bounds(df, ["id", "none", "one"], 2)
    assert bounds["none"] == [] and bounds["one"] == [3.0]
    assert bounds["id"] == pytest.approx([2500, 5000, 7500], abs=300)
    assert layout.clustered(df, ["none", "id"]).count() == 10000
    assert layout.clustered(df.filter("id < 0"), ["id"]).count() == 0


def test_one_value_spreads_over_partitions(spark):
    df = spark.range(0, 8000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id")).alias("a"), "id")
    sizes = layout.clustered(df, ["a"], files=8).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in sizes) == 8000 and max(r["count"] for r in sizes) < 2000


def test_rebalanced_and_partitioned_write(spark, tmp_path):
    df = spark.range(1000).select("id", (F.col("id") % 3).cast("string").alias("m"))
    assert layout.rebalanced(df, files=3).rdd.getNumPartitions() == 3
    assert layout.rebalanced(df, "m").count() == 1000 and layout.rebalanced(df).count() == 1000
    path = str(tmp_path / "p")
    layout.partitioned_write(df, path, "m", ["id"], max_records_per_file=200)
    assert len(parts(path)) >= 6
    out = tables.read_table(spark, path, df.schema)
    assert out.schema.simpleString() == df.schema.simpleString() and out.count() == 1000 and out.filter("m = '1'").count() == 333


def test_optimize_and_analyze(spark, tmp_path):
    path = str(tmp_path / "o")
    layout.optimize_for_reads(spark.range(100), path, ["id"], table="optimized_numbers")
    stats = {r.col_name: r.data_type for r in spark.sql("describe extended optimized_numbers").collect()}
    assert "100 rows" in stats["Statistics"]
    # Published again, the table shows the new rows; other columns are refused.
    layout.optimize_for_reads(spark.range(7), path, ["id"], table="optimized_numbers")
    assert spark.table("optimized_numbers").count() == 7
    with pytest.raises(AnalysisException):
        layout.optimize_for_reads(spark.range(3).withColumnRenamed("id", "n"), path, ["n"], table="optimized_numbers")
    assert spark.table("optimized_numbers").count() == 7
    spark.sql("drop table optimized_numbers")


def test_a_managed_table_keeps_its_rows(spark, tmp_path):
    spark.range(5).write.saveAsTable("managed_numbers")
    with pytest.raises(AnalysisException):
        layout.optimize_for_reads(spark.range(9), str(tmp_path / "it's"), ["id"], table="managed_numbers")
    assert spark.table("managed_numbers").count() == 5 and not tables.table_exists(spark, str(tmp_path / "it's"))
    for n in (4, 6):
        layout.optimize_for_reads(spark.range(n), str(tmp_path / "it's"), ["id"], table="quoted_numbers")
        assert spark.table("quoted_numbers").count() == n
    for name in ("managed_numbers", "quoted_numbers"):
        spark.sql(f"drop table {name}")


def drifting(spark, landing):
    """Files with the same column as int, bigint, double and string."""
    for i, kind in enumerate(["int", "bigint", "double", "string", "bigint"]):
        df = spark.createDataFrame([(i, f"f{i}")], "a int, s string").withColumn("a", F.col("a").cast(kind))
        df.coalesce(1).write.parquet(f"{landing}/month={i}/x")


def test_load_files_with_drifting_types(spark, tmp_path):
    from pyspark.sql import types as T

    landing = str(tmp_path / "landing")
    drifting(spark, landing)
    listed = [r.path for r in files.list_files(spark, landing).collect()]
    assert len(listed) == 5
    schema = T.StructType.fromDDL("a bigint, s string")
    assert rows(files.load_files(spark, listed, schema)) == [(i, f"f{i}") for i in range(5)]
    assert files.list_files(spark, landing, exclude=["month=0"]).count() == 4


def test_loads_do_not_depend_on_grouping(spark, tmp_path):
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL("a bigint, s string")
    for i in range(16):
        drift = spark.createDataFrame([(str(i) if i % 2 else i, f"f{i}")], f"a {'string' if i % 2 else 'int'}, s string")
        drift.coalesce(1).write.parquet(str(tmp_path / f"alternating/{i:02}"))
    listed = [r.path for r in files.list_files(spark, str(tmp_path / "alternating")).collect()]
    assert len(files._by_schema(spark, listed)) == 2
    assert rows(files.load_files(spark, listed, schema)) == sorted([(i, f"f{i}") for i in range(16)], key=repr)
    spark.createDataFrame([(99,)], "a int").coalesce(1).write.parquet(str(tmp_path / "alternating/99"))
    for size in (1, 3, 1000):
        to = [str(tmp_path / f"{name}{size}") for name in ("bronze", "ledger")]
        with pytest.raises(AnalysisException, match=r"alternating/99.*lacks the declared columns \['s'\]"):
            files.ingest_files(spark, str(tmp_path / "alternating"), *to, schema, max_files=size)


def test_batch_ingest(spark, tmp_path):
    from pyspark.sql import types as T

    landing, bronze, ledger = (str(tmp_path / n) for n in ("landing", "bronze", "ledger"))
    drifting(spark, landing)
    schema = T.StructType.fromDDL("a bigint, s string")
    run = lambda **kw: files.ingest_files(spark, landing, bronze, ledger, schema, **kw)
    assert files.read_bronze(spark, bronze, ledger, schema).count() == 0
    assert run(exclude=["month=4"], max_files=3) == 4
    assert run(exclude=["month=4"]) == 0
    assert files.read_bronze(spark, bronze, ledger, schema).count() == 4
    assert run() == 1
    assert rows(files.read_bronze(spark, bronze, ledger, schema)) == [(i, f"f{i}") for i in range(5)]
    assert files.read_ledger(spark, ledger).count() == 5
    assert files.read_bronze(spark, bronze, ledger, schema, after=2).count() == 1
    # A load written without its ledger entry is not seen, and is replaced.
    spark.createDataFrame([(99, "lost")], schema).write.parquet(tables.version_dir(bronze, 4))
    assert files.read_bronze(spark, bronze, ledger, schema).count() == 5
    spark.createDataFrame([(6, "f6")], schema).coalesce(1).write.parquet(f"{landing}/month=6/x")
    assert run() == 1
    assert (99, "lost") not in rows(files.read_bronze(spark, bronze, ledger, schema))
    assert files.read_bronze(spark, bronze, ledger, schema).count() == 6


def test_plain_reads_and_append(spark, tmp_path):
    path = str(tmp_path / "plain")
    df = spark.createDataFrame([(1, datetime(2024, 1, 1))], "a int, t timestamp_ntz")
    files.append_parquet(df, path)
    files.append_parquet(df, path)
    assert files.read_parquet(spark, path).count() == 2
    assert files.read_parquet(spark, [path], df.schema).schema == df.schema
