import random

from pyspark.sql import functions as F

from forkline.functions import u256

EDGES = [0, 1, 2 ** 32 - 1, 2 ** 32, 2 ** 64 - 1, 2 ** 64, 10 ** 26 - 1, 10 ** 26, 2 ** 126 - 1, 2 ** 126, 10 ** 38,
         2 ** 128 - 1, 2 ** 128, 10 ** 52 - 1, 10 ** 52, 2 ** 255, 2 ** 256 - 1]


def values():
    r = random.Random(7)
    return EDGES + [r.getrandbits(r.randint(1, 256)) for _ in range(200)]


def frame(spark):
    return spark.createDataFrame([(str(v), v.to_bytes(32, "big")) for v in values()], "d string, b binary")


def test_round_trip_and_comparison(spark):
    rows = frame(spark).select(
        "d", "b", u256.from_be("b").alias("text"), u256.to_be("d").alias("bytes"),
        u256.be_greater("b", 10 ** 21).alias("g1"), u256.hex_greater(F.hex("b"), 10 ** 21).alias("g2")).collect()
    for r in rows:
        assert r.text == r.d
        assert bytes(r.bytes) == bytes(r.b)
        assert r.g1 == r.g2 == (int(r.d) > 10 ** 21)


def test_short_and_long_hex(spark):
    df = spark.createDataFrame([("", "0"), ("ff", "255"), ("FF", "255"), ("1" + "0" * 64, "0")], "h string, want string")
    assert all(r.got == r.want for r in df.select("want", u256.from_hex("h").alias("got")).collect())


def test_exact_signed_sums(spark):
    df = frame(spark).withColumn("w", F.when(F.length("d") % 2 == 0, -1).otherwise(1))
    r = df.agg(u256.sum_signed("d").alias("plus"), u256.sum_signed("d", "-1").alias("minus"),
               u256.sum_signed("d", "w").alias("mixed"), u256.sum_signed("'0'").alias("zero")).first()
    total = sum(values())
    assert int(r.plus) == total and int(r.minus) == -total and r.zero == "0"
    assert int(r.mixed) == sum(v if len(str(v)) % 2 else -v for v in values())


def test_sum_of_nothing_is_null(spark):
    assert frame(spark).where("d = 'x'").agg(u256.sum_signed("d").alias("t")).first().t is None
