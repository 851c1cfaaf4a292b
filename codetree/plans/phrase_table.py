"""The phrase table: each listed code with its prefixes, ranges and common phrases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codetree.functions.text import tokens
from codetree.operators.levels import char_positions
from codetree.operators.phrases import code_spine, phrase_mine
from codetree.staging import stage

# Output column and the working column it shows.
OUTPUT = {
    "ICD10_RAW": "original",
    "ICD10_CD": "code",
    "FULL_DESCRIPTION": "description",
    "CHAR_1": "C1",
    "CHAR_2": "N1",
    "CHAR_3": "N2",
    "CHAR_5": "D1",
    "CHAR_6": "D2",
    "CHAR_7": "D3",
    "CHAR_8": "D4",
    "FIRST_3": "code_3",
    "FIRST_5": "code_5",
    "FIRST_6": "code_6",
    "FIRST_7": "code_7",
    "FIRST_8": "code_8",
    "HIGH_LEVEL": "level_1",
    "HIGH_LEVEL_TEXT": "label_1",
    "SUB_LEVEL": "level_2",
    "SUB_LEVEL_TEXT": "label_2",
    "LEFTHAND_TEXT": "C3_text",
    "RIGHTHAND_TEXT": "search_base",
    "CHAR_5_TEXT": "c5_phrase",
    "CHAR_6_TEXT": "c6_phrase",
    "CHAR_7_TEXT": "c7_phrase",
    "CHAR_8_TEXT": "c8_phrase",
}


def listed_codes(listing: DataFrame) -> DataFrame:
    """(original, code, description): a dot after three characters, always."""
    code = F.concat(F.substring("original", 1, 3), F.lit("."), F.expr("substring(original, 4)"))
    return listing.select("original", code.alias("code"), "description")


def phrase_table(listing: DataFrame, categories: DataFrame, stop_words: list[str] | None = None) -> DataFrame:
    """``listing`` is (original, description); ``categories`` is (ord, code, description)."""
    codes = listed_codes(listing)
    phrases = stage(phrase_mine(codes, stop_words=stop_words), "phrases")
    spine = stage(code_spine(categories), "spine")
    return (
        char_positions(codes)
        .drop("C1", "N1", "N2")
        .withColumn("description", F.lower("description"))
        .withColumn("search_base", F.array_join(tokens(F.col("description"), stop_words), " "))
        .join(phrases, "code")
        .join(spine, "code_3", "left")
        .select(*[F.col(c).alias(name) for name, c in OUTPUT.items()])
    )
