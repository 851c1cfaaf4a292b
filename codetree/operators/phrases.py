"""Common-phrase mining: the words that codes with the same prefix share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from codetree.functions.text import tokens
from codetree.operators.levels import char_positions
from codetree.operators.ordered import fill_down
from codetree.staging import stage


def tokenize(df: DataFrame, text: str = "description", stop_words: list[str] | None = None) -> DataFrame:
    """One row per word of ``text`` with its position from 1; other columns stay."""
    keep = [c for c in df.columns if c != text]
    return df.select(
        *keep, F.posexplode(tokens(F.col(text), stop_words)).alias("pos", "word")
    ).select(*keep, (F.col("pos") + 1).alias("ord"), "word")


def _level_counts(words: DataFrame) -> DataFrame:
    """(code, the levels' keys, word, n, group, n_<level>): how often a code has a word, and how often the code's group of each level.

    All keys refine the 5-character prefix, so one exchange by it and the word serves every level.
    ``group`` is a hash of both, which orders faster.
    """
    counts = char_positions(words).withColumnRenamed("D4", "char_8").repartition("code_5", "word")
    counts = counts.groupBy("code", "code_5", "code_6", "code_7", "char_8", "word").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("group", F.xxhash64("code_5", "word"))
    # The longest prefix comes first: its order serves the shorter ones as well.
    for level, finer in ((7, ["code_6", "code_7"]), (6, ["code_6"]), (5, []), (8, ["char_8"])):
        counts = counts.withColumn(f"n_{level}", F.sum("n").over(W.partitionBy("group", "word", "code_5", *finer)))
    return counts


def _most_frequent(counts: DataFrame, keys: list[str], level: int, taken: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """(group, keys, word): the words with the highest count of their group of the level, ties included; staged.

    ``taken`` are the words of the levels before, with their keys. Only words that a level before has used in the same 5-character
    prefix are counted anew, without the codes it used them for; the counts of all others hold. Two words whose hashes are
    equal are both counted anew.
    """
    columns = ["group", *keys, "word"]
    rest = counts.select(*columns, F.col(f"n_{level}").alias("n"))
    if taken:
        used = stage(reduce(DataFrame.union, [t.select("group") for t, _ in taken]).distinct(), f"used-{level}")
        again = counts.join(used, "group", "left_semi")
        for found, own in taken:
            again = again.join(found, [*own, "word"], "left_anti")
        again = stage(again.groupBy(*columns).agg(F.sum("n").alias("n")), f"counts-{level}")
        rest = rest.join(used, "group", "left_anti").unionByName(again)
    highest = stage(rest.groupBy(*keys).agg(F.max("n").alias("n")), f"highest-{level}")
    return stage(rest.join(highest, [*keys, "n"]).select(columns).distinct(), f"words-{level}")


def _phrase(words: DataFrame, keys: list[str], name: str) -> DataFrame:
    listed = F.array_join(F.array_sort(F.collect_list("word")), " ")
    return words.groupBy(*keys).agg(listed.alias(name))


def phrase_mine(
    df: DataFrame, code: str = "code", text: str = "description", stop_words: list[str] | None = None
) -> DataFrame:
    """(code, c5_phrase, c6_phrase, c7_phrase, c8_phrase) per code with words.

    The phrase of a prefix is its most frequent words, in alphabetical order,
    without the words of the shorter prefixes; prefixes are taken in the order
    5, 6, 8, 7, where 8 means the 5-character prefix plus the 8th character.

    Words are counted once, for all levels together. A level then takes the highest counts, and
    counts anew only the few words that levels before it have used.
    """
    words = tokenize(df.select(F.col(code).alias("code"), text), text, stop_words).select("code", "word")
    levels = {5: ["code_5"], 6: ["code_6"], 8: ["code_5", "char_8"], 7: ["code_7"]}
    counts = stage(_level_counts(words), "counts")
    found: dict[int, DataFrame] = {}
    for level, keys in levels.items():
        found[level] = _most_frequent(counts, keys, level, [(t, levels[n]) for n, t in found.items()])

    codes = char_positions(counts.select("code").distinct()).withColumnRenamed("D4", "char_8")
    for level, keys in sorted(levels.items()):
        codes = codes.join(_phrase(found[level], keys, f"c{level}_phrase"), keys, "left")
    return codes.select("code", *[f"c{n}_phrase" for n in (5, 6, 7, 8)])


def code_spine(categories: DataFrame) -> DataFrame:
    """Every code A00..Z99 with its high and low range and category title, filled down.

    ``categories`` is (ord, code, description): ranges such as ``A00-B99`` whose
    title has a dot are high level, other ranges are low level, and codes of
    three characters are categories. ``ord`` is the order of the list.
    """
    spark = categories.sparkSession
    letter = F.char(F.floor(F.col("id") / 100) + 65)
    digits = F.lpad((F.col("id") % 100).cast("string"), 2, "0")
    grid = spark.range(26 * 100).select(F.concat(letter, digits).alias("code_3"))

    titled = categories.withColumn("description", F.replace("description", F.lit(" and "), F.lit(" & ")))
    is_range = F.col("code").contains("-")
    high = titled.filter(is_range & F.col("description").contains(".")).select(
        F.substring("code", 1, 3).alias("code_3"),
        F.regexp_replace("description", ". .*", "").alias("level_1"),
        F.col("description").alias("label_1"),
        F.col("ord").alias("_o1"),
    )
    low = titled.filter(is_range & ~F.col("description").contains(".")).select(
        F.substring("code", 1, 3).alias("code_3"),
        F.regexp_replace("code", ". .*", "").alias("level_2"),
        F.col("description").alias("label_2"),
        F.col("ord").alias("_o2"),
    )
    single = titled.filter(F.length("code") == 3).select(
        F.col("code").alias("code_3"), F.col("description").alias("C3_text"), F.col("ord").alias("_o3")
    )
    rows = grid.join(high, "code_3", "left").join(low, "code_3", "left").join(single, "code_3", "left")
    filled = fill_down(
        rows,
        ["level_1", "label_1", "level_2", "label_2", "C3_text"],
        order_by=["code_3", "_o1", "_o2", "_o3"],
        bucket=F.substring("code_3", 1, 1),
    ).drop("_o1", "_o2", "_o3")
    return filled.select(
        F.substring("code_3", 1, 1).alias("C1"),
        F.substring("code_3", 2, 1).alias("N1"),
        F.substring("code_3", 3, 1).alias("N2"),
        "*",
    )


def _literal(word: Column) -> Column:
    """A pattern that matches the word itself, whatever signs it holds."""
    return F.regexp_replace(word, r"([\\^$.|?*+()\[\]{}])", r"\\$1")


def neighbour_diff(df: DataFrame, text: str, near: str, suffix: str) -> DataFrame:
    """Text without the words of its neighbour, and the part both share.

    ``near`` holds the neighbour's text; its words, cut at white space and taken as they are, are removed wherever they
    occur, also inside longer words, the longest possible first. What is left, as one piece, is removed
    from the text to give the shared part. A null neighbour gives nulls, one without words removes nothing.
    """
    words = F.filter(F.split(near, r"\s"), lambda w: w != "")
    longest_first = F.array_sort(F.transform(words, lambda w: F.struct(-F.length(w), w.alias("w"))))
    pattern = F.array_join(F.transform(longest_first, lambda x: _literal(x["w"])), "|")
    different = F.regexp_replace(F.col(text), pattern, F.lit(""))
    shared = F.replace(F.col(text), F.col(f"different_{suffix}"), F.lit(""))
    return df.withColumn(f"different_{suffix}", different).withColumn(f"same_{suffix}", shared)
