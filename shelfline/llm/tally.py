"""Words of whole texts counted within a task, so that only sums are shuffled."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

# Distinct keys that one task counts before it hands its sums on.
HELD = 300_000
# Bytes of a text that are split into words at once.
PIECE = 1 << 20
# Rows of one batch of sums.
SUM_ROWS = 20_000


def pieces(data: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The words between the spaces of a text, a bounded part of it at a time."""
    at = 0
    while len(data) - at > size:
        end = data.rfind(b" ", at, at + size) + 1
        # A word longer than a piece is taken whole.
        end = end or data.find(b" ", at + size) + 1 or len(data)
        yield data[at:end].split()
        at = end
    yield data[at:].split()


def summed(tally: dict[tuple, Counter]) -> Iterator[tuple[tuple, list[bytes], list[int]]]:
    """The counts by key, as bounded lists of words and of their numbers."""
    for key, counted in tally.items():
        words, ns = list(counted), list(counted.values())
        for i in range(0, len(words), SUM_ROWS):
            yield key, words[i : i + SUM_ROWS], ns[i : i + SUM_ROWS]
