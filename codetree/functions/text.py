"""Column helpers for descriptions: trimming, cleaning, tokens and word differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from codetree.functions.stopwords import description_stop_words

# The elements that mark revisions inside mixed text.
REVISION_TAGS = ("diff", "new", "old", "unc")

# The numerals of each decimal place.
ROMAN = (
    ("", "M", "MM", "MMM"),
    ("", "C", "CC", "CCC", "CD", "D", "DC", "DCC", "DCCC", "CM"),
    ("", "X", "XX", "XXX", "XL", "L", "LX", "LXX", "LXXX", "XC"),
    ("", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"),
)
_NUMERAL = "^(?=.)M{0,3}(CM|CD|D?C{0,3})(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})$"

# The characters that trimming removes.
BLANKS = " \t\r\n"


def trim_ws(col: Column) -> Column:
    """Text without blanks at its ends."""
    return F.btrim(col, F.lit(BLANKS))


def squeeze(col: Column) -> Column:
    """Runs of spaces become one space."""
    return F.regexp_replace(col, " {2,}", " ")


def strip_revision_tags(col: Column) -> Column:
    """Text of an element that was read with its revision mark-up."""
    return F.regexp_replace(col, f"</?(?:{'|'.join(REVISION_TAGS)})(?:\\s[^>]*)?/?>", "")


def replace_first(col: Column, pattern: str, replacement: str) -> Column:
    """Replace only the first match; texts without one are left as they are."""
    replaced = F.regexp_replace(col, f"(?s)^(.*?)(?:{pattern})", f"$1{replacement}")
    return F.when(F.rlike(col, F.lit(pattern)), replaced).otherwise(col)


def roman(col: Column) -> Column:
    """Roman numeral of 1..3999, in upper case where it is one already; null for anything else."""
    text = F.upper(F.btrim(col.cast("string")))
    n = text.try_cast("int")
    places = [
        F.element_at(F.array(*[F.lit(r) for r in place]), (F.floor(n / 10**power) % 10 + 1).cast("int"))
        for power, place in zip((3, 2, 1, 0), ROMAN)
    ]
    return F.when(n.between(1, 3999), F.concat(*places)).when(F.rlike(text, F.lit(_NUMERAL)), text)


def _without_commas(col: Column) -> Column:
    return F.replace(F.coalesce(col, F.lit("")), F.lit(","), F.lit(" "))


def _words(col: Column) -> Column:
    return F.split(_without_commas(col), " ")


def word_diff(text: Column, reference: Column) -> Column:
    """Words of ``text`` that ``reference`` lacks: unique, in first-seen order."""
    known = F.split(trim_ws(_without_commas(reference)), " ")
    left = F.array_except(_words(text), known)
    return trim_ws(squeeze(F.array_join(left, " ")))


def delete_punctuation(col: Column) -> Column:
    """Keep letters, digits and spaces; other characters are deleted, not blanked."""
    return F.regexp_replace(col, r"[^\p{IsAlphabetic}\p{Nd} ]+", "")


def tokens(col: Column, stop_words: list[str] | None = None) -> Column:
    """Lower-case words of a description, in order, without stop words."""
    stop = description_stop_words() if stop_words is None else stop_words
    words = F.split(delete_punctuation(F.lower(col)), " ")
    return F.filter(words, lambda w: (w != "") & ~w.isin(*stop))
