"""Reading the public tokenizer files, and cutting texts where a tokenizer never looks across."""

from __future__ import annotations

import functools
import os
import re

from tokenizers import Tokenizer, normalizers, pre_tokenizers

# What any Unicode table or program counts as white space.
_BLANK = "\\t\\n\\x0b\\x0c\\r\\x1c-\\x1f \\x85\\xa0\\u1680\\u180e\\u2000-\\u200b\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff"
_ASCII_BLANK = " \\t\\n\\r\\x0b\\x0c"

# A chunk ends where something that is surely no blank is followed by an ASCII blank: a pre-tokenizer that attaches
# blanks to the following word decides everything within such a chunk.
CHUNKS = re.compile(f"[{_ASCII_BLANK}]*[^{_ASCII_BLANK}]+(?:(?<=[{_BLANK}])[{_ASCII_BLANK}]+[^{_ASCII_BLANK}]*)*"
                    f"|[{_ASCII_BLANK}]+")
BLANK = re.compile(f"[{_BLANK}]")

# The pre-tokens of byte-level BPE, for texts of printable ASCII and Latin letters only (fixed values).
WESTERN = re.compile("[\\t\\n\\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]*")
_LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f"
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^ \\t\\n\\r{_LETTER}0-9]+"
                    f"|[ \\t\\n\\r]+(?![^ \\t\\n\\r])|[ \\t\\n\\r]+")
# For tokenizers that drop blanks: chunks of any text, and the words of a lower-cased Western European text. The one
# Latin letter left out (U+0130) becomes two when lower-cased.
WESTERN_BLANKS = re.compile("[\\t\\n\\x0b\\x0c\\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]*")
_LOWER = "a-z\u00df-\u00f6\u00f8-\u017f"
LOWER_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LOWER}]+|[0-9]|[^{_ASCII_BLANK}{_LOWER}0-9]+")
END_OF_WORD = "</w>"
SOLID = re.compile(f"[^{_ASCII_BLANK}]+")


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=4)
def load(path: str) -> Tokenizer:
    """One tokenizer per worker process, without threads of its own, truncation or padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@functools.lru_cache(maxsize=2)
def merges_only(path: str) -> Tokenizer:
    """The same vocabulary and merges for words that are already normalized, split and spelled in byte letters."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.normalizer = normalizers.Sequence([])
    tokenizer.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    return tokenizer


@functools.cache
def byte_alphabet() -> dict[int, str]:
    """The letters a byte-level vocabulary writes for bytes: printable ones for themselves, the rest from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


def byte_letters(word: str) -> str:
    return word.encode().decode("latin-1").translate(byte_alphabet())
