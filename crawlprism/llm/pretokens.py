"""Splitting text into the pieces that a byte-level BPE merges separately."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

import regex


@lru_cache(8)
def splitter(pattern: str) -> Callable[[str], list[str]]:
    """A function that gives all matches of ``pattern`` in a text.

    Text within Latin-1 goes through the standard library's faster engine, with the classes written out from the
    general engine's own view of those 256 characters. The matches are the same.
    """
    general = regex.compile(pattern)

    def members(cls: str) -> str:
        return "".join(re.escape(chr(c)) for c in range(256) if regex.fullmatch(cls, chr(c)))

    space, letter, number = members(r"\s"), members(r"\p{L}"), members(r"\p{N}")
    latin = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{letter}{number}]")
    for cls, written in ((r"\p{L}", f"[{letter}]"), (r"\p{N}", f"[{number}]"), (r"\s", f"[{space}]"), (r"\S", f"[^{space}]")):
        latin = latin.replace(cls, written)
    if regex.search(r"(?<!\\)\\[a-zA-Z]", regex.sub(r"\\x[0-9a-f]{2}|\\[tnvfr]", "", latin)):
        return general.findall  # the pattern uses classes beyond these
    fast = re.compile(latin)

    def split(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return general.findall(text)
        return fast.findall(text)

    return split
