"""Token ids of whole texts with a public tokenizer file, one tokenizer per worker.

Texts are encoded by the tokenizers library. A tokenizer that lower-cases, cuts
texts into words by the one pattern below and merges inside words gives each
word the same ids wherever it stands, so its words are cut here, ids of a word come from the
library's model and are remembered. Everything else (other tokenizers,
characters above U+00FF, marks of special tokens) goes through the library's
``encode``, in pieces between spaces for a tokenizer of that kind, whole otherwise.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
from collections.abc import Iterable

import numpy as np

# Words remembered per worker.
CACHE_WORDS = 1_200_000

# The word pattern and normalizers of tokenizers whose words can be cut here.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]

_LATIN = [chr(i) for i in range(256)]
_LETTERS = re.escape("".join(c for c in _LATIN if unicodedata.category(c)[0] == "L"))
_NUMBERS = re.escape("".join(c for c in _LATIN if unicodedata.category(c)[0] == "N"))
_WHITE = re.escape("\t\n\x0b\x0c\r \x85\xa0")
_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_WHITE}{_LETTERS}{_NUMBERS}]+")
_OTHER = re.compile(r"[^\x00-\xff]|<\|")


def _byte_letters() -> dict[int, str]:
    """The characters that stand for the UTF-8 bytes of each character up to U+00FF.

    Printable bytes stand for themselves, the others for U+0100 and up, in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    letter = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return {i: "".join(letter[b] for b in chr(i).encode()) for i in range(256)}


class _WordIds(dict):
    """Ids of words as bytes; a word that is new is asked of the library's model."""

    def __init__(self, model, letter: str):
        self.model, self.letter, self.letters = model, letter, _byte_letters()

    def __missing__(self, word: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(word.translate(self.letters))]
        self[word] = held = struct.pack(f"<{len(ids)}{self.letter}", *ids)
        return held


class TokenIds:
    """Encodes texts with the tokenizer file at ``path``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        cut = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.by_word = (
            (spec.get("normalizer") or {}).get("normalizers") == _NORMALIZERS
            and len(cut) == 2
            and cut[0].get("pattern") == {"Regex": _PATTERN}
            and cut[1].get("type") == "ByteLevel"
            and not cut[1].get("add_prefix_space")
            and spec["model"]["type"] == "BPE"
            and not spec["model"].get("dropout")
        )
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.known = _WordIds(self.tokenizer.model, "H" if self.kind.itemsize == 2 else "I")
        self.pieces: dict[str, bytes] = {}

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _plain(self, text: str) -> bytes:
        """Ids of a text without characters above U+00FF."""
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        return b"".join(map(self.known.__getitem__, _WORDS.findall(text.lower())))

    def _piece(self, piece: str) -> bytes:
        if not _OTHER.search(piece):
            return self._plain(piece)
        if piece not in self.pieces:
            if len(self.pieces) > CACHE_WORDS:
                self.pieces.clear()
            self.pieces[piece] = self._library(piece)
        return self.pieces[piece]

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of one text; none for a null or empty one."""
        if not text:
            return np.zeros(0, self.kind)
        if not self.by_word:
            held = self._library(text)
        elif not _OTHER.search(text):
            held = self._plain(text)
        else:
            held = b"".join(map(self._piece, re.split("[ \n]+", text)))
        return np.frombuffer(held, self.kind)

    def encode_all(self, texts: Iterable[str | None], end: int) -> Iterable[np.ndarray]:
        """Ids of each text followed by the id ``end``, as little-endian unsigned 32-bit integers."""
        for text in texts:
            ids = self.encode(text)
            out = np.empty(len(ids) + 1, "<u4")
            out[:-1] = ids
            out[-1] = end
            yield out
