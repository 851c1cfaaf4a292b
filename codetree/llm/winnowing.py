"""Document fingerprints by winnowing, with DataFrame functions only.

A text is cut into words, every run of ``gram`` words is hashed, and of every
``window`` consecutive hashes the smallest is kept, the rightmost of equal ones,
together with its position. Any ``window + gram - 1`` words that two texts
share therefore leave a common fingerprint entry, whatever stands around them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

GRAM = 5
WINDOW = 16

# A kept hash is one long: 32 bits of the hash above 31 bits that fall as the position grows.
_LAST = (1 << 31) - 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def winnow(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """Kept hashes of a text, in order of position, as ``array<long>``.

    Words are runs of characters other than white space (space and
    U+0009..U+000D), in lower case. With fewer than ``gram`` words the whole
    sequence is one run; without words, or for a null text, the result is empty.
    """
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def grams(h: Column) -> Column:
        runs = F.greatest(F.size(h) - (gram - 1), F.lit(1))
        packed = lambda i, hashed: F.shiftleft(F.shiftrightunsigned(hashed, 32), 31).bitwiseOR(
            F.lit(_LAST) - i
        )
        short = F.array(packed(F.lit(0), F.xxhash64(h)))
        long = F.transform(
            F.sequence(F.lit(0), runs - 1), lambda i: packed(i, F.xxhash64(*[F.get(h, i + j) for j in range(gram)]))
        )
        return F.when(F.size(h) == 0, F.array().cast("array<bigint>")).when(F.size(h) < gram, short).otherwise(long)

    def least(packed: Column) -> Column:
        windows = F.greatest(F.size(packed) - (window - 1), F.lit(1))
        each = F.transform(F.sequence(F.lit(1), windows), lambda i: F.array_min(F.slice(packed, i, window)))
        return F.when(F.size(packed) == 0, packed).otherwise(F.array_distinct(each))

    return _let(_let(F.transform(words, lambda w: F.xxhash64(w)), grams), least)


def as_text(kept: Column) -> Column:
    """Fingerprint as text: ``position:hash`` in hex, separated by spaces."""
    entry = lambda x: F.concat_ws(
        ":",
        (F.lit(_LAST) - x.bitwiseAND(F.lit(_LAST))).cast("string"),
        F.lower(F.hex(F.shiftright(x, 31))),
    )
    return F.array_join(F.transform(kept, entry), " ")


def hashes(kept: Column) -> Column:
    """The hashes of a fingerprint without their positions."""
    return F.array_distinct(F.transform(kept, lambda x: F.shiftright(x, 31)))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of hashes; two empty ones are alike."""
    either = F.size(a) + F.size(b)
    return _let(
        F.size(F.array_intersect(a, b)),
        lambda both: F.when(either == 0, F.lit(1.0)).otherwise(both / F.greatest(either - both, F.lit(1))),
    )


def with_next(df: DataFrame, order: list[str], derived: dict[str, Column], values: list[str], prefix: str = "next_") -> DataFrame:
    """Add ``derived`` columns, and the ``values`` of the next row in descending order (after the last: of the first).

    ``df`` has the columns of ``order``. The first is a number; nulls come last. The order is cut into
    buckets at quantiles of it, so one exchange deals out the rows, and only
    the first row of each bucket, a row per shuffle partition, goes to the bucket before.
    """
    first = order[0]
    count = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / count for i in range(1, count)]
    cuts = sorted(set(df.agg(F.percentile_approx(first, shares, 10_000)).first()[0] or []))
    # Buckets rise along the descending order.
    above = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c >= F.col(first))) if cuts else F.lit(0)
    bucket = F.when(F.col(first).isNull(), F.lit(len(cuts) + 1)).otherwise(above)
    rows = df.withColumn("_bucket", bucket)
    heads = rows.groupBy("_bucket").agg(F.max(F.struct(*order)).alias("_head"))
    along = W.partitionBy(F.lit(0)).orderBy("_bucket")
    before = heads.select(  # a row per bucket
        "_bucket",
        F.coalesce(
            F.lag("_bucket").over(along),
            F.last("_bucket").over(along.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)),
        ).alias("_to"),
    )
    edges = heads.join(before, "_bucket").select(F.col("_to").alias("_bucket"), "_head.*").withColumn("_edge", F.lit(1))
    stacked = rows.withColumn("_edge", F.lit(0)).unionByName(edges).withColumns(derived)
    falling = [F.col(c).desc_nulls_last() for c in order]
    window = W.partitionBy("_bucket").orderBy("_edge", *falling)
    moved = stacked.withColumns({prefix + v: F.lead(v).over(window) for v in values})
    return moved.filter("_edge = 0").drop("_edge", "_bucket")


def fingerprints(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every row's text and of its edited text, and how alike they are.

    The edited text has its last floor(n / 2) code points replaced by the first
    as many (or all) of the next row's, in descending id (after the last row: the first; null ids
    come last, equal ids by descending text). A null text is empty. Returns
    ``id_column, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    Equal texts have equal fingerprints; two empty fingerprints are alike (1.0). Other columns are not looked at.
    """
    rows = df.select(F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    rows = with_next(rows, ["id", "body"], {"kept": winnow(F.col("body"))}, ["body", "kept"])
    half = F.floor(F.length("body") / 2).cast("int")
    edited = F.concat(F.expr("left(body, length(body) - cast(floor(length(body) / 2) as int))"), F.substring("next_body", F.lit(1), half))
    rows = rows.select("id", "body", "kept", F.col("next_kept").alias("kept_next"), edited.alias("edited"))
    rows = rows.withColumn("kept_edited", winnow(F.col("edited")))
    rows = rows.withColumns({f"{c}_hashes": hashes(F.col(c)) for c in ("kept", "kept_edited", "kept_next")})
    own = F.col("kept_hashes")
    return rows.select(
        F.col("id").alias(id_column),
        F.length("body").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("kept")).alias("fingerprint"),
        as_text(F.col("kept_edited")).alias("edited_fingerprint"),
        likeness(own, F.col("kept_edited_hashes")).alias("near_edited"),
        likeness(own, F.col("kept_next_hashes")).alias("near_next"),
    )
