"""Every part has a code of its own, whatever the number of parts."""

from pyspark.sql import functions as F

from codetree.plans.views import VIEWS, _PART_CODES

DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS = "PQRABCDEFGHIJKLMNOSTUVWX"


def plain_code(part, size):
    block, high = part // 46_656, part // 373_248
    tail = ""
    while high:
        tail, high = DIGITS[high % 36] + tail, high // 36
    low = part % 46_656
    return f"{LETTERS[part % 3 + 3 * (block % 8)]}{size:02d}.{DIGITS[low // 1296]}{DIGITS[low // 36 % 36]}{DIGITS[low % 36]}{tail}"


def parts(spark, numbers):
    return numbers.select(
        F.col("id").alias("p_partkey"), (F.col("id") * 7 % 50 + 1).cast("int").alias("p_size"), F.lit("PROMO").alias("p_type"),
        F.concat_ws(" ", F.lit("name"), "id").alias("p_name"), F.lit("Brand#2").alias("p_brand"),
    )


def test_codes_of_200_000_parts_differ(spark):
    codes = spark.sql(_PART_CODES, part=parts(spark, spark.range(200_000)))
    assert codes.select("code").distinct().count() == 200_000
    rows = codes.filter("p_partkey % 997 = 0").collect()
    assert all(r.code == plain_code(r.p_partkey, r.p_size) for r in rows)


def test_codes_of_far_parts(spark):
    numbers = [0, 46_655, 46_656, 373_247, 373_248, 13_436_927, 13_436_928, 20_000_000_000, 483_729_408 * 36 - 1]
    codes = spark.sql(_PART_CODES, part=parts(spark, spark.createDataFrame([(n,) for n in numbers], "id long"))).collect()
    assert {r.p_partkey: r.code for r in codes} == {n: plain_code(n, n * 7 % 50 + 1) for n in numbers}
    assert len({r.code for r in codes}) == len(numbers)


def test_no_name_is_lost(spark):
    """Names of the deepest nodes of 120,000 parts, all of them shipped."""
    part = parts(spark, spark.range(120_000))
    lines = spark.range(120_000).select(F.col("id").alias("l_partkey"), F.to_timestamp(F.lit("1995-01-01")).alias("l_shipdate"))
    nodes = spark.sql(VIEWS["nodes"], part=part, lineitem=lines)
    assert nodes.filter("title LIKE 'Explicit%'").select("title").distinct().count() == 120_000
