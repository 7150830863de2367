"""Normal text and words, as all duplicate operators read them."""

from __future__ import annotations

import re
import unicodedata

import regex

_FORMAT = regex.compile(r"\p{Cf}+")
_WORDS = re.compile(r"[^\W_]+")


def normal(text: str) -> str:
    """NFKC form without invisible (format) characters, in lower case."""
    if text.isascii():
        return text.lower()
    return _FORMAT.sub("", unicodedata.normalize("NFKC", text)).lower()


def words(text: str) -> list[str]:
    """The longest runs of letters and digits of a normal text."""
    return _WORDS.findall(text)
