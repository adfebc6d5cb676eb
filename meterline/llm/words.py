"""Words of whole texts inside tasks: ``[^\\x20\\x09-\\x0D]+``, numbered, a bounded slice of a text at a time."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

from meterline.llm.common import BLANK, WORD

SLICE = 1 << 20

_WORD = re.compile(WORD)
_BLANK = re.compile(BLANK)


class Numbering(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n

    def of(self, text: str) -> np.ndarray:
        """The numbers of the words of a text; strings of one slice only are alive beside the distinct words."""
        parts = [np.fromiter(map(self.__getitem__, words), np.int64, len(words)) for words in slices(text)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.int64)


def slices(text: str) -> Iterator[list[str]]:
    """The words of a text, in lists of about ``SLICE`` characters that never cut a word."""
    start = 0
    while start < len(text):
        cut = _BLANK.search(text, start + SLICE)
        end = cut.start() if cut else len(text)
        yield _WORD.findall(text, start, end)
        start = end
