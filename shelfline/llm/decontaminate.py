"""Benchmark decontamination with one Aho-Corasick automaton."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from hashlib import sha256

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import WORD_BYTES, numbered, over_batches, written

WINDOW = 10
# Bytes of test texts in one automaton (some 100 bytes of memory each at most), and with it
# what is on the driver, or broadcast, at once.
BLOCK_BYTES = 1 << 20
_WORD = re.compile(rb"[^ ]+")


def normal(text: str | None) -> bytes:
    """Lower-cased words, byte for byte at their places; everything else is a space."""
    return (text or "").encode("utf-8", "replace").translate(WORD_BYTES)


def windows(text: str | None, size: int = WINDOW) -> list[bytes]:
    """The runs of ``size`` words of an item; a shorter item is one window."""
    words = normal(text).split()
    if not words:
        return []
    return [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


class Scanner:
    """Finds all windows of a block of test items in one pass over a text."""

    def __init__(self, items: Sequence[tuple[str, str | None]], size: int = WINDOW):
        owners: dict[bytes, set[str]] = {}
        for item, text in items:
            for w in windows(text, size):
                owners.setdefault(w, set()).add(item)
        self.found = ahocorasick.Automaton()
        for w, ids in owners.items():
            self.found.add_word(f" {w.decode('latin-1')} ", (w.count(b" ") + 1, frozenset(ids)))
        if owners:
            self.found.make_automaton()
        self.empty = not owners

    def scan(self, data: bytes) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit stretches as word numbers from and to (exclusive), and the items found.

        ``data`` is normalised text with single spaces, one ahead and one behind.
        """
        hits, items = [], set()
        if not self.empty:
            for end, (n, ids) in self.found.iter(data.decode("latin-1")):
                # A hit ends with the space behind its last word.
                hits.append((end, n))
                items |= ids
        if not hits:
            return [], items
        # Words before a place are the spaces before it, but for the leading one.
        stretches, seen, at = [], 0, 0
        for end, n in hits:
            seen += data.count(b" ", at, end)
            at = end
            stretches.append((seen - n, seen))
        return merged(stretches), items


def merged(stretches: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching stretches joined."""
    out: list[list[int]] = []
    for a, b in sorted(stretches):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """Test items with the number of their ``block``, and how many blocks there are.

    Blocks hold about ``block_bytes`` of text. Items without words, and null texts, never
    match and are left out. A null id counts as an empty one.
    """
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text")
    ).where("text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // block_bytes) or 1
    return items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n))), n


def _scanned(docs: DataFrame, items: DataFrame, block: int, size: int, finish, schema) -> DataFrame:
    """One pass over whole texts with the automaton of one block, built once a task."""
    own = [(r.item, r.text) for r in items.where(F.col("block") == block).orderBy("item", "text").collect()]
    shared = docs.sparkSession.sparkContext.broadcast(own)

    def make():
        scan = Scanner(shared.value, size).scan

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            raw = [normal(t) for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            single = [b" ".join([b"", *d.split(), b""]) for d in raw]
            found = [scan(d) for d in single]
            return finish(batch, raw, single, [hits for hits, _ in found], [ids for _, ids in found])

        return run

    return over_batches(docs, make, schema)


_HITS = "array<struct<first: long, last: long, start: long, end: long>>"
_HIT = pa.list_(pa.struct([(x, pa.int64()) for x in ("first", "last", "start", "end")]))


def _found(batch, raw, single, hits, items, kept: list[str]) -> pa.RecordBatch:
    """Words and hits of every text: words and code points from and to, and the items found."""
    column = dict(zip(batch.schema.names, batch.columns))
    stretches = []
    for text, data, found in zip(column["text"].to_pylist(), raw, hits):
        places = _original(text or "", data, found) if found else []
        stretches.append([dict(zip(("first", "last", "start", "end"), (*w, *c))) for w, c in zip(found, places)])
    return pa.RecordBatch.from_arrays(
        [
            *[column[c] for c in kept],
            pa.array([max(0, d.count(b" ") - 1) for d in single], pa.int64()),
            pa.array(stretches, _HIT),
            pa.array([sorted(i) for i in items], pa.list_(pa.string())),
        ],
        [*kept, "n_words", "hits", "items"],
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Where test items occur in documents.

    Returns ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans``; spans are
    start and end of hit stretches in the original text, in code points, as an array of
    structs. One automaton scans every text once and documents are not shuffled. A test set
    above ``block_bytes`` is cut into blocks with an automaton each: every block is one pass
    over the texts, of which only the hits are written, so work grows in proportion, and no
    more than one block is on the driver, broadcast, or in a task at a time. The hits of the
    passes meet by row number.

    A null or empty text has no words and no hits; equal windows of several items count for
    each, repeated items once; without items nothing is contaminated. Repeated documents
    are scanned one by one, an empty table gives no rows, other columns are ignored.
    """
    items, blocks = item_blocks(benchmark, block_bytes)
    rows = docs.select("doc_id", "text")
    if blocks == 1:
        kept = ["doc_id"]
    else:
        kept, rows = ["rid", "doc_id"], numbered(rows, "numbered-texts")
    kinds = "".join(f"{c} {t}, " for c, t in rows.select(kept).dtypes)
    schema = f"{kinds}n_words long, hits {_HITS}, items array<string>"

    def finish(*parts) -> pa.RecordBatch:
        return _found(*parts, kept)

    found = _scanned(rows, items, 0, size, finish, schema)
    if blocks > 1:
        # The first pass gives a row for every text, the others for those with hits.
        passes = [written(found, "block-hits")]
        for block in range(1, blocks):
            passes.append(written(_scanned(rows, items, block, size, finish, schema).where(F.size("hits") > 0), "block-hits"))
        found = passes[0]
        for more in passes[1:]:
            found = found.unionByName(more)
        found = found.groupBy("rid").agg(
            F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
            F.flatten(F.collect_list("hits")).alias("hits"), F.flatten(F.collect_list("items")).alias("items"),
        )
    hits = _joined(F.array_sort("hits"))
    named = found.withColumns({"hits": hits, "items": F.array_sort(F.array_distinct("items"))})
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["last"] - h["first"])
    return named.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
        F.transform("hits", lambda h: F.struct(h["start"].alias("start"), h["end"].alias("end"))).alias("spans"),
    )


def _joined(hits):
    """Stretches in order, those that overlap or touch joined into one."""

    def step(done, h):
        top = F.element_at(done, -1)
        longer = F.struct(
            top["first"].alias("first"), F.greatest(top["last"], h["last"]).alias("last"),
            top["start"].alias("start"), F.greatest(top["end"], h["end"]).alias("end"),
        )
        joins = (F.size(done) > 0) & (h["first"] <= F.try_element_at(done, F.lit(-1))["last"])
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(h)))

    return F.when(F.size(hits) < 2, hits).otherwise(F.aggregate(hits, F.array().cast(_HITS), step))


def _original(text: str, data: bytes, found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code point offsets of word stretches."""
    places = [m.span() for m in _WORD.finditer(data)]
    ends = [(places[a][0], places[b - 1][1]) for a, b in found]
    encoded = text.encode("utf-8", "replace")
    out, seen, at = [], 0, 0
    for a, b in ends:
        start = seen + len(encoded[at:a].decode("utf-8", "ignore"))
        seen, at = start + len(encoded[a:b].decode("utf-8", "ignore")), b
        out.append((start, seen))
    return out


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The documents in which no window of a test item occurs, with all their columns.

    Null and empty texts hold no words and stay; repeated rows are kept or dropped alike; an
    empty table stays empty. Further columns of any name stay as they are; the text is found
    by its name in any case. Each block of a large test set is one pass, which leaves the
    documents that it finds clean to the next.
    """
    items, blocks = item_blocks(benchmark, block_bytes)
    # Rows are carried as one column beside the text, so that no name can clash.
    left = docs.select(F.col("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))

    def finish(batch, raw, single, hits, ids):
        return batch.filter(pa.array([not h for h in hits], pa.bool_()))

    for block in range(blocks):
        left = _scanned(left, items, block, size, finish, left.schema)
        if block + 1 < blocks:
            left = written(left, "clean-so-far")
    return left.select("row.*")
