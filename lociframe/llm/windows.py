"""Windows of long texts for helpers that gather what they find in lists."""

from __future__ import annotations

import re
from collections.abc import Iterator

WINDOW_CHARS = 1 << 20
#: Between a visible character and a space or line feed every word ends, whatever else words are made of.
END = re.compile(r"(?<=\S)[ \n]")


def windows(text: str, size: int = WINDOW_CHARS) -> Iterator[str]:
    """The text in parts that begin at the first such space after ``size`` characters; a text without one is a single part."""
    at = 0
    while len(text) - at > size and (found := END.search(text, at + size)):
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]
