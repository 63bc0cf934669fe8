"""Exact token counts of every prefix by dynamic programming."""

from __future__ import annotations

import json
from bisect import bisect_right
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from shelfline.llm.common import over_batches

# How the byte-level vocabulary cuts a text into pieces before merging (fixed value).
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LIMIT = 512
# Pieces whose counts a worker remembers; beyond it the memory starts anew.
REMEMBERED = 400_000
# Characters of a piece from which its prefixes are counted all at once.
LONG_PIECE = 64


def byte_letters() -> dict[str, int]:
    """The printable letters that byte-level vocabularies write for the 256 bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Token counts of all prefixes of a text, under a byte-level BPE vocabulary.

    The merges turn a piece of text into one fixed token sequence. The sequence of a prefix
    is that of a shorter prefix plus one last token, and a token may follow exactly when the
    merges leave the two side by side. So walking through a piece, every position finds its
    last token among the vocabulary words ending there, and its count is one more than the
    count where that token begins.
    """

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        letters = byte_letters()
        spelled = {w: bytes(letters[c] for c in w) for w in spec["model"]["vocab"]}
        self.words = {spelled[w] for w in spelled}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.ranks = {(spelled[a], spelled[b]): r for r, (a, b) in enumerate(pairs)}
        self.special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.pieces = regex.compile(PIECES)
        self.ends = ahocorasick.Automaton()
        for word in self.words:
            self.ends.add_word(word.decode("latin-1"), word)
        self.ends.make_automaton()
        self.follows: dict[tuple[bytes, bytes], bool] = {}
        self.known = _Remembered(self)

    def merged(self, data: bytes) -> list[bytes]:
        """Plain merging of a short byte string: the lowest rank first, leftmost first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _may_follow(self, last: bytes, word: bytes) -> bool:
        found = self.follows.get((last, word))
        if found is None:
            if len(self.follows) >= 4 * REMEMBERED:
                self.follows.clear()
            found = self.merged(last + word) == ([last, word] if last else [word])
            self.follows[last, word] = found
        return found

    def piece_counts(self, piece: bytes) -> list[int]:
        """Tokens of every byte prefix of one piece, the empty one included."""
        counts, last = [0] * (len(piece) + 1), [b""] * (len(piece) + 1)
        # Words come by the position where they end; exactly one of them fits.
        for end, word in self.ends.iter(piece.decode("latin-1")):
            if counts[end + 1]:
                continue
            begin = end + 1 - len(word)
            if self._may_follow(last[begin], word):
                counts[end + 1], last[end + 1] = counts[begin] + 1, word
        return counts

    def _split(self, text: str) -> list[tuple[str, bool]]:
        """Ordinary stretches and special tokens, in order."""
        parts = [(text, False)]
        for token in self.special:
            parts = [
                (bit, special or bit == token)
                for chunk, special in parts
                for bit in ([chunk] if special else regex.split(f"({regex.escape(token)})", chunk))
                if bit
            ]
        return parts

    def count(self, text: str) -> int:
        known, pieces = self.known, self.pieces
        if any(token in text for token in self.special):
            return sum(1 if special else sum(map(known.__getitem__, pieces.findall(part))) for part, special in self._split(text))
        return sum(map(known.__getitem__, pieces.findall(text)))

    def table(self, text: str) -> PrefixTable:
        return PrefixTable(self, text)


class _Remembered(dict):
    """Token counts of whole pieces, worked out when first met."""

    def __init__(self, counter: PrefixCounter):
        super().__init__()
        self.counter = counter

    def __missing__(self, piece: str) -> int:
        found = self.counter.piece_counts(piece.encode("utf-8", "replace"))[-1]
        if len(self) >= REMEMBERED:
            self.clear()
        if len(piece) <= 64:
            self[piece] = found
        return found


class PrefixTable:
    """Answers for one text: tokens of any prefix, and the longest prefix within a budget."""

    def __init__(self, counter: PrefixCounter, text: str):
        self.counter, self.text = counter, text
        # Where pieces begin, the tokens ahead of them, and whether the piece is special.
        self.begins, self.ahead, self.kinds, place, total = [], [], [], 0, 0
        for part, special in counter._split(text):
            for piece in [part] if special else counter.pieces.findall(part):
                self.begins.append(place)
                self.ahead.append(total)
                self.kinds.append(special)
                place += len(piece)
                total += 1 if special else counter.known[piece]
        self.total = total

    def tokens(self, length: int) -> int:
        """Tokens of the first ``length`` characters.

        Pieces before the one that is cut stay as they are, but for white space next to the
        cut and a special token that is cut, whose piece is read again with the tail.
        """
        if length >= len(self.text):
            return self.total
        if length <= 0:
            return 0
        at = max(0, bisect_right(self.begins, length - 1) - 1)
        if self.kinds[at] and at and not self.kinds[at - 1]:
            at -= 1
        while at and not self.kinds[at - 1] and self.text[self.begins[at - 1] : self.begins[at]].isspace():
            at -= 1
        return self.ahead[at] + self.counter.count(self.text[self.begins[at] : length])

    def truncated(self, budget: int) -> int:
        """The longest prefix, in characters, with at most ``budget`` tokens.

        Counts can fall when a character completes a word, so the last fitting length is
        sought from the far side. Pieces beyond the budget are skipped; a long piece is read
        once for the counts of all its prefixes, and what it proposes is verified.
        """
        if self.total <= budget:
            return len(self.text)
        far = bisect_right(self.ahead, budget)
        length = self.begins[far] if far < len(self.begins) else len(self.text)
        while length:
            at = bisect_right(self.begins, length - 1) - 1
            if length - self.begins[at] > LONG_PIECE and not self.kinds[at]:
                length = self._within(at, length, budget)
            if self.tokens(length) <= budget:
                return length
            length -= 1
        return 0

    def _within(self, at: int, length: int, budget: int) -> int:
        """The longest prefix that ends in piece ``at`` and fits, by the counts of the piece."""
        letters = self.text[self.begins[at] : length]
        counts = self.counter.piece_counts(letters.encode("utf-8", "replace"))
        end = len(counts) - 1
        for n in range(len(letters), 0, -1):
            if self.ahead[at] + counts[end] <= budget:
                return self.begins[at] + n
            end -= len(letters[n - 1].encode("utf-8", "replace"))
        return self.begins[at] + 1


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Tokens of every whole text: ``doc_id, n_bytes, n_tokens, over_limit``.

    ``path`` is the vocabulary file, at the same place on every machine. Strings of special
    tokens inside a text count as that token, as the vocabulary's library reads them by
    default. A null or empty text has no bytes and no tokens; repeated rows are counted one
    by one, an empty table gives no rows, other columns are ignored.
    """

    def make():
        count = counter(path).count

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            tokens = [count(t) for t in texts]
            sizes = [len(t.encode("utf-8", "replace")) for t in texts]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

        return run

    kind = dict(docs.dtypes)["doc_id"]
    return over_batches(
        docs.select("doc_id", "text"), make, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )


def truncations(docs: DataFrame, path: str, budget: int = LIMIT) -> DataFrame:
    """Where texts are cut to fit a budget: ``doc_id, n_tokens, kept_chars, kept_tokens``.

    ``kept_chars`` is the longest prefix in code points with at most ``budget`` tokens,
    answered from the prefix counts. Null and empty texts keep nothing of nothing.
    """

    def make():
        known = counter(path)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            tables = [known.table(t or "") for t in batch.column(1).to_pylist()]
            kept = [t.truncated(budget) for t in tables]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x, pa.int64()) for x in (
                    [t.total for t in tables], kept, [t.tokens(n) for t, n in zip(tables, kept)])]],
                ["doc_id", "n_tokens", "kept_chars", "kept_tokens"],
            )

        return run

    kind = dict(docs.dtypes)["doc_id"]
    return over_batches(
        docs.select("doc_id", "text"), make, f"doc_id {kind}, n_tokens long, kept_chars long, kept_tokens long"
    )
