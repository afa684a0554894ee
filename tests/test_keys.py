import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from shopmart.functions import address_key


def _expected(text):
    return Decimal(int(hashlib.sha1(text.encode()).hexdigest()[:16], 16))


def test_concat_skips_null_keeps_empty(spark):
    df = spark.createDataFrame([("1", None, "", "x")], "a string, b string, c string, d string")
    got = df.select(address_key(["a", "b", "c", "d"], "billing").alias("k")).collect()[0].k
    assert got == _expected("1,,x,billing")


def test_high_bit_key_is_exact(spark):
    # find a part whose key is above 2^63 (would overflow a bigint)
    part = next(str(i) for i in range(1000) if int(hashlib.sha1(f"{i},billing".encode()).hexdigest()[:16], 16) >= 2 ** 63)
    df = spark.createDataFrame([(part,)], "a string")
    got = df.select(address_key(["a"], "billing").alias("k")).collect()[0].k
    assert got == _expected(f"{part},billing") and got >= 2 ** 63


def test_no_address_parts_gives_null(spark):
    df = spark.createDataFrame([(None, None)], "a string, b string")
    assert df.select(address_key(["a", "b"], "shipping").alias("k")).collect()[0].k is None
