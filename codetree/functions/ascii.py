"""Latin to ASCII transliteration as ``translate`` plus one lookup of what becomes several characters."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Latin letters without a canonical decomposition, one to one.
SINGLE = {
    "ø": "o", "đ": "d", "ð": "d", "ł": "l", "ŀ": "l", "ħ": "h", "ı": "i", "ĸ": "q", "ŋ": "n", "ŧ": "t", "ſ": "s",
    "Ø": "O", "Đ": "D", "Ð": "D", "Ł": "L", "Ŀ": "L", "Ħ": "H", "Ŋ": "N", "Ŧ": "T",
    "ƒ": "f", "Ɓ": "B", "ɓ": "b", "Ɗ": "D", "ɗ": "d", "ƙ": "k", "ƚ": "l", "ƞ": "n", "Ɵ": "O", "ƥ": "p", "ƫ": "t", "ƭ": "t",
    "Ʋ": "V", "ƶ": "z", "Ƶ": "Z", "ǥ": "g", "Ǥ": "G", "ȷ": "j", "ȡ": "d", "ȴ": "l", "ȵ": "n", "ȶ": "t",
    "‘": "'", "’": "'", "‚": ",", "‹": "<", "›": ">", "“": '"', "”": '"',
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "×": "*", "÷": "/", "\u00a0": " ",
}

# Characters that become several ASCII characters.
MULTIPLE = {
    "ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ĳ": "ij", "ŉ": "'n",
    "Æ": "AE", "Œ": "OE", "Þ": "TH", "Ĳ": "IJ",
    "ǆ": "dz", "ǉ": "lj", "ǌ": "nj", "ǳ": "dz", "Ǆ": "DZ", "Ǉ": "LJ", "Ǌ": "NJ", "Ǳ": "DZ",
    "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st",
    "¼": " 1/4", "½": " 1/2", "¾": " 3/4", "©": "(C)", "®": "(R)",
    "„": ",,", "«": "<<", "»": ">>", "…": "...",
}

# Latin-1 Supplement, Latin Extended-A/B and Latin Extended Additional.
RANGES = ((0x00C0, 0x0250), (0x1E00, 0x1F00))


def _single_pairs() -> dict[str, str]:
    pairs = dict(SINGLE)
    for first, end in RANGES:
        for char in map(chr, range(first, end)):
            base = unicodedata.normalize("NFD", char)[0]
            if base != char and (base.isascii() or base in SINGLE):
                pairs[char] = SINGLE.get(base, base)
    return pairs


def _multiple_pairs() -> dict[str, str]:
    pairs = dict(MULTIPLE)
    for first, end in RANGES:
        for char in map(chr, range(first, end)):
            base = unicodedata.normalize("NFD", char)[0]
            if base != char and base in MULTIPLE:
                pairs[char] = MULTIPLE[base]
    return pairs


_PAIRS = _single_pairs()
_SPELLED = _multiple_pairs()


# A place beside a character that becomes several.
_BESIDE = "(?<=[{0}])|(?=[{0}])".format("".join(_SPELLED))


def to_ascii(col: Column) -> Column:
    """Replace Latin letters with diacritics and typographic signs by ASCII.

    Letters with one substitute are translated; a text with others is cut beside them, and each
    is looked up once.
    """
    single = F.translate(col, "".join(_PAIRS.keys()), "".join(_PAIRS.values()))
    table = F.create_map(*[F.lit(x) for pair in _SPELLED.items() for x in pair])
    pieces = F.transform(F.split(single, _BESIDE), lambda p: F.coalesce(F.try_element_at(table, p), p))
    spelled = F.when(F.rlike(single, F.lit(f"[{''.join(_SPELLED)}]")), F.array_join(pieces, "")).otherwise(single)
    plain = F.regexp_replace(spelled, r"(?<=[A-Za-z0-9])\p{Mn}+", "")
    # Most texts are ASCII already: as many bytes as characters.
    return F.when(F.octet_length(col) == F.length(col), col).otherwise(plain)


def ascii_lower(col: Column) -> Column:
    return to_ascii(F.lower(col))
