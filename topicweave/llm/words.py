"""Cutting text where a byte-level tokenizer always cuts it, so that the parts can be remembered.

The public splitting pattern joins one space to the run that follows it and never
puts a non-space and a later space in one match.  A single space between two
non-space characters therefore starts a match whatever stands around it, and a
text's ids are those of its parts in order.
"""

from __future__ import annotations

import re
from collections.abc import Callable

_AT = re.compile(r"(?<=\S) (?=\S)")
_OTHER = re.compile(r"\s\s|^\s|\s$")


def parts_of(text: str) -> list[str]:
    """The parts of a text; all but the first have lost the one space before them."""
    return _AT.split(text) if _OTHER.search(text) else text.split(" ")


class Remembered(dict):
    """Values of a function, forgotten all at once when there are ``most`` of them."""

    def __init__(self, of: Callable[[str], bytes], most: int = 300_000):
        super().__init__()
        self._of, self._most = of, most

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self._most:
            self.clear()
        value = self[key] = self._of(key)
        return value
