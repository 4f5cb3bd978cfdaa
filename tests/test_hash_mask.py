import hashlib
from datetime import datetime

import pytest
from conftest import plan, rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from stratalake.operators import hashing, masking


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_row_hash_joins_texts_and_skips_nulls(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    hashes = [r.row_hash for r in hashing.with_row_hash(df, ["x", "y", "z"]).collect()]
    assert hashes == [sha("a|b")] * 2
    strict = [r.row_hash for r in hashing.with_row_hash(df, ["x", "y", "z"], null_token="N").collect()]
    assert strict == [sha("a|\\N|b"), sha("a|b|\\N")]
    with pytest.raises(AnalysisException):
        hashing.with_row_hash(df, ["x", "w"])


def test_null_token_keeps_separators_and_tokens_apart(spark):
    data = [("a|b", "c"), ("a", "b|c"), ("\\N", "c"), (None, "c"), ("a\\", "|c"), ("a\\|", "c")]
    df = spark.createDataFrame(data, "x string, y string")
    strict = hashing.with_row_hash(df, ["x", "y"], null_token="N")
    assert strict.select("row_hash").distinct().count() == len(data)


def test_hash_value_is_the_fingerprint(spark):
    df = spark.createDataFrame([(3, "c"), (1, None)], "n int, s string").repartition(3)
    assert hashing.dataset_hash_value(df, ["n", "s"]) == hashing.dataset_fingerprint(df, ["n", "s"]).first().dataset_hash


def test_fingerprint(spark):
    df = spark.range(1000).select("id", F.col("id").cast("string").alias("s"))
    base = hashing.dataset_fingerprint(df, ["id", "s"]).first()
    for other in (df.repartition(7), df.orderBy(F.desc("id"))):
        assert hashing.dataset_fingerprint(other, ["id", "s"]).first() == base
    for other in (df.limit(999), df.union(df.limit(1)), df.withColumn("s", F.when(F.col("id") == 5, "x").otherwise(F.col("s")))):
        assert hashing.dataset_fingerprint(other, ["id", "s"]).first() != base
    # The definition, by hand.
    lanes = [0] * 13
    for i in range(1000):
        h = sha(f"{i}|{i}")
        for w in range(4):
            word = int(h[15 * w:15 * w + 15], 16)
            for part in range(3):
                lanes[3 * w + part] += (word >> (20 * part)) & (2**20 - 1)
        lanes[12] += int(h[60:], 16)
    assert tuple(base) == (1000, sha("-".join(map(str, [1000] + lanes))))
    assert hashing.dataset_fingerprint(df.filter("false"), ["id"]).first().n_rows == 0


def test_fingerprint_moves_one_row_per_task(spark):
    text = plan(hashing.dataset_fingerprint(spark.range(10), ["id"]))
    assert "Sort" not in text and text.count("Exchange") == 1 and "partial_sum" in text


def test_masks(spark):
    df = spark.createDataFrame(
        [("123.456.789-00", "joao@x.com", "11987654321"), ("12345678900", "ab", "123"), ("12", "", "(11) 9-8765"), (None, None, None)],
        "cpf string, mail string, fone string",
    )
    out = masking.mask_all(df, ["cpf"], ["mail"], ["fone"], ["cpf"])
    assert out.columns == ["cpf", "mail", "fone", "cpf_masked", "mail_masked", "fone_masked", "cpf_hash"]
    assert [r.cpf_masked for r in out.collect()] == ["***.456.***-**", "***.456.***-**", "***..***-**", None]
    assert [r.mail_masked for r in out.collect()] == ["joa***@***.com", "ab***@***.com", "***@***.com", None]
    assert [r.fone_masked for r in out.collect()] == ["***-4321", "***-123", "***-8765", None]
    assert [r.cpf_hash for r in out.collect()] == [sha("123.456.789-00"), sha("12345678900"), sha("12"), None]
    bare = masking.mask_all(df, ["cpf"], hashed=["mail"], drop_originals=True, salt="pepper")
    assert bare.columns == ["fone", "cpf_masked", "mail_hash"] and bare.first().mail_hash == sha("pepperjoao@x.com")
    assert masking.mask_all(df).columns == df.columns


def test_single_masks(spark):
    df = spark.createDataFrame([("12345678900", 42, datetime(2024, 1, 1))], "a string, n int, t timestamp_ntz")
    assert masking.mask_cpf(df, "a", "m").first().m == "***.456.***-**"
    assert masking.mask_email(df, "a").first().a_masked == "123***@***.com"
    assert masking.mask_phone(df, "a").first().a_masked == "***-8900"
    assert masking.hash_column(df, "n").first().n_hash == sha("42")
    assert rows(masking.hash_column(df, "t", "h").select("h")) == [(sha("2024-01-01 00:00:00"),)]
    with pytest.raises(AnalysisException):
        masking.mask_cpf(df, "nope")
