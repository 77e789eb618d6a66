"""Texts as independent units for byte-level BPE with the usual word pattern.

A match of the pattern never runs from other characters into white space, so a
text may be cut wherever white space follows something else; each unit (white
space, then the rest) encodes alone. Units repeat, so a worker process keeps
the ids of those it has met.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import regex

#: Fixed value: the Unicode White_Space characters.
WHITE = "\t-\r \x85\xa0  -     　"
UNIT = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
#: Longest unit kept, and how many a worker keeps before it starts anew.
KEPT_CHARS, KEPT_UNITS = 64, 400_000


class UnitIds(dict):
    """unit -> ids as little-endian unsigned 32-bit integers; ``encode`` gives
    them for one match of the pattern."""

    def __init__(self, pattern: str, encode: Callable[[str], bytes]):
        super().__init__()
        white = f"[{WHITE}]"
        self.matches = regex.compile(pattern.replace(r"\S", f"[^{WHITE}]").replace(r"[^\s", f"[^{WHITE}").replace(r"\s", white)).findall
        self.encode = encode

    def __missing__(self, unit: str) -> bytes:
        parts = self.matches(unit)
        ids = self.encode(unit) if len(parts) == 1 else b"".join([self[p] if p != unit else self.encode(p) for p in parts])
        if len(unit) <= KEPT_CHARS:
            if len(self) >= KEPT_UNITS:
                self.clear()
            self[unit] = ids
        return ids

    def text_ids(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, UNIT.findall(text)))
