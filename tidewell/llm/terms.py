"""Terms of texts: runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower case.

Every byte of a character beyond ASCII is 0x80 or more, so terms are found on bytes: all others become blanks, and words between
blanks are terms.
"""

from __future__ import annotations

import numpy as np

from tidewell.llm import flat

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] = LOWER[97:123]
TERM_BYTES = np.full(256, 0x20, dtype=np.uint8)
_INSIDE = [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]
TERM_BYTES[_INSIDE] = LOWER[_INSIDE]


def words_of(table: np.ndarray, data: np.ndarray, offsets: np.ndarray, lo: int, hi: int) -> flat.Words:
    """The words of rows lo to hi after every byte went through ``table``."""
    return flat.Words(table[data[offsets[lo] : offsets[hi]]], offsets[lo : hi + 1] - offsets[lo])
