"""Near-duplicates by SimHash fingerprints, found with vantage-point trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfline.llm.common import hashable, over_batches, written

SHINGLE = 3
DISTANCE = 3
SEED = 42
# Fingerprints that one task holds in its tree, about, and as many that it seeks there; and
# those in a leaf of the tree.
SHARD_ROWS = 131_072
LEAF_ROWS = 128
# Fingerprints, chosen by hash, on which the upper levels of the tree are laid out: so many a
# shard, but never more than the driver can well hold.
LAYOUT_ROWS_A_SHARD = 64
LEAST_LAYOUT_ROWS = 8_192
MOST_LAYOUT_ROWS = 1 << 20
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits, each set when it is set in over half of the shingle hashes."""
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, stops)], dtype="<u8")
    if n <= 255:
        counts = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    else:
        counts = np.zeros(64, np.int64)
        for i in range(0, n, 65_536):
            counts += np.unpackbits(hashes[i : i + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, *more: Column) -> DataFrame:
    """``doc_id, fp``: fingerprints of whole texts as signed longs, with further columns."""

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = np.array([fingerprint(t, shingle) for t in batch.column(0).to_pylist()], np.uint64)
            return pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found.view(np.int64))], [*batch.schema.names[1:], "fp"])

        return run

    rows = docs.select("text", "doc_id", *more)
    kinds = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes[1:])
    return over_batches(rows, make, f"{kinds}, fp long")


def _distance(points: np.ndarray, to: int | np.ndarray) -> np.ndarray:
    return np.bitwise_count(points ^ to)


class Layout:
    """Upper levels of a vantage-point tree: a point goes to the shards its ball overlaps.

    Every inner node has a vantage fingerprint and a radius; points within the radius belong
    to the near side, others to the far side. A point is at home in one shard and visits all
    others in which a point within ``reach`` bits of it can be at home. Nodes are divided
    until ``most`` points of the sample, at most, are at home in each shard.
    """

    def __init__(self, sample: np.ndarray, most: float):
        self.nodes: dict[int, tuple[np.uint64, int]] = {}
        todo = [(1, np.unique(sample))]
        while todo:
            node, own = todo.pop()
            # Numbers of nodes are longs; so deep a node holds points that no radius parts.
            if len(own) <= max(1, most) or node >= 1 << 60:
                continue
            # The vantage point with the widest spread of distances among a few candidates.
            tried = own[:: max(1, len(own) // 8)][:8]
            spread = [_distance(own, v).std() for v in tried]
            vantage = tried[int(np.argmax(spread))]
            d = _distance(own, vantage)
            radius = int(np.median(d))
            if radius >= d.max():
                radius = int(d.max()) - 1
            self.nodes[node] = (vantage, radius)
            todo += [(2 * node, own[d <= radius]), (2 * node + 1, own[d > radius])]

    def route(self, points: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the point, shard, and whether the point is at home there."""
        out = []
        todo = [(1, np.arange(len(points)), np.ones(len(points), bool))]
        while todo:
            node, at, home = todo.pop()
            if not len(at):
                continue
            if node not in self.nodes:
                out.append((at, np.full(len(at), node, np.int64), home))
                continue
            vantage, radius = self.nodes[node]
            d = _distance(points[at], vantage).astype(np.int64)
            near = d <= radius + reach
            far = d > radius - reach
            todo.append((2 * node, at[near], home[near] & (d[near] <= radius)))
            todo.append((2 * node + 1, at[far], home[far] & (d[far] > radius)))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        return tuple(np.concatenate(x) for x in zip(*out))


class Forest:
    """Joined sets of points by position; each set is known by its smallest position."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join the sets of ``a[i]`` and ``b[i]`` for all i."""
        while len(a):
            ra, rb = self.of(a), self.of(b)
            open_ = ra != rb
            a, b = a[open_], b[open_]
            low, high = np.minimum(ra, rb)[open_], np.maximum(ra, rb)[open_]
            np.minimum.at(self.up, high, low)

    def of(self, at: np.ndarray) -> np.ndarray:
        """The sets of some points."""
        root = self.up[at]
        while True:
            above = self.up[root]
            if np.array_equal(above, root):
                self.up[at] = root
                return root
            root = above

    def roots(self) -> np.ndarray:
        return self.of(np.arange(len(self.up)))


def join_close(
    points: np.ndarray, homes: int, reach: int, leaf: int = LEAF_ROWS, seekers: np.ndarray | None = None
) -> np.ndarray:
    """Set numbers of points, where points within ``reach`` bits share a set.

    The first ``homes`` points are held in a vantage-point tree; all points, or those at the
    places ``seekers``, are sought in it. A branch is left out when the triangle inequality
    shows that nothing in it is close enough. Only joined sets are kept, never the pairs;
    where a whole branch is one set, its members need not seek it, so that a large group of
    copies is soon done with.
    """
    forest = Forest(len(points))
    rng = np.random.default_rng(10)
    todo = [(np.arange(homes), np.arange(len(points)) if seekers is None else seekers)]
    while todo:
        own, seekers = todo.pop()
        if len(own) and len(seekers):
            sets = forest.of(own)
            if (sets == sets[0]).all():
                seekers = seekers[forest.of(seekers) != sets[0]]
        if not len(own) or not len(seekers):
            continue
        split = None
        if len(own) > leaf:
            chosen = own[rng.integers(len(own))]
            vantage = points[chosen]
            d = _distance(points[own], vantage).astype(np.int64)
            radius = int(np.median(d))
            if radius >= d.max():
                radius = int(d.max()) - 1
            if radius >= d.min():
                split = chosen, d, radius
        if split is None:
            step = max(1, 2_000_000 // len(own))
            for i in range(0, len(seekers), step):
                part = seekers[i : i + step]
                s, o = np.nonzero(_distance(points[part][:, None], points[own][None, :]) <= reach)
                forest.join(part[s], own[o])
            continue
        chosen, d, radius = split
        e = _distance(points[seekers], points[chosen]).astype(np.int64)
        close = seekers[e <= reach]
        forest.join(close, np.full(len(close), chosen))
        todo.append((own[d <= radius], seekers[e <= radius + reach]))
        todo.append((own[d > radius], seekers[e > radius - reach]))
    return forest.roots()


def _layout(points: DataFrame, shard_rows: int) -> Layout:
    """The layout of a bounded sample, chosen by hash."""
    n = points.count()
    wanted = min(MOST_LAYOUT_ROWS, max(LEAST_LAYOUT_ROWS, LAYOUT_ROWS_A_SHARD * n // shard_rows))
    every = max(1, n // wanted)
    sample = points.where(F.pmod(F.xxhash64("fp", F.lit(7)), F.lit(every)) == 0).select("fp").toArrow()
    drawn = sample.column("fp").to_numpy().astype(np.int64).view(np.uint64)
    return Layout(drawn, shard_rows * len(drawn) / max(1, n))


def cells(points: DataFrame, layout: Layout, reach: int, shard_rows: int) -> DataFrame:
    """Points in the cells where they are held or sought: ``shard, i, j, held, seeks, fp``.

    Every point is at home in one shard and visits those that its ball overlaps. The homes of
    a shard are dealt to parts ``i`` and all its points to parts ``j``, of about
    ``shard_rows`` each, as many as the shard's counted rows need. A cell holds the homes of
    one ``i`` and seeks the points of one ``j`` there, so it is bounded however full its
    shard is, and every home meets every visitor in one cell.
    """
    shared = points.sparkSession.sparkContext.broadcast(layout)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy()
            at, shard, home = shared.value.route(fp.astype(np.int64).view(np.uint64), reach)
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(home), pa.array(fp[at])], ["shard", "home", "fp"])

    routed = written(points.select("fp").mapInArrow(route, "shard long, home boolean, fp long"), "routed")
    # Parts have a little room, since hashes fill them unevenly.
    parts = lambda n: F.ceil(n / F.lit(0.9 * shard_rows))
    sizes = written(routed.groupBy("shard").agg(parts(F.count_if("home")).alias("n_i"), parts(F.count("*")).alias("n_j")), "shard-sizes")
    placed = routed.join(sizes, "shard").withColumns({"own_i": F.pmod(F.xxhash64("fp"), "n_i"), "own_j": F.pmod(F.xxhash64("fp", F.lit(1)), "n_j")})
    # A home is held in all cells of its i, a point is sought in all cells of its j.
    rows = F.expr("IF(home AND n_i > 0, sequence(0L, n_j - 1), array())")
    held = F.transform(rows, lambda j: F.struct(F.col("own_i").alias("i"), j.alias("j"), F.lit(True).alias("held"), (j == F.col("own_j")).alias("seeks")))
    columns = F.expr("IF(n_i > 0, filter(sequence(0L, n_i - 1), x -> NOT home OR x <> own_i), array())")
    sought = F.transform(columns, lambda i: F.struct(i.alias("i"), F.col("own_j").alias("j"), F.lit(False).alias("held"), F.lit(True).alias("seeks")))
    return placed.select("shard", "fp", F.inline(F.concat(held, sought)))


def close_links(points: DataFrame, reach: int = DISTANCE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links that join all distinct fingerprints within ``reach`` bits: ``a, b``.

    ``points`` has distinct fingerprints ``fp``. The links of a cell form a star for each
    joined set, so there are at most as many as points in the cells. The layout of the shards
    comes from a bounded sample; every fingerprint is routed by it.
    """

    def stars(key: tuple, batch: pa.Table) -> pa.Table:
        fp = np.concatenate([c.to_numpy() for c in batch.column("fp").chunks])
        held, seeks = (np.concatenate([c.to_numpy(zero_copy_only=False) for c in batch.column(x).chunks]) for x in ("held", "seeks"))
        order = np.lexsort((fp, ~held))
        fp, seeks = fp[order], seeks[order]
        roots = join_close(fp.astype(np.int64).view(np.uint64), int(held.sum()), reach, seekers=np.nonzero(seeks)[0])
        linked = roots != np.arange(len(fp))
        return pa.table({"a": pa.array(fp[linked]), "b": pa.array(fp[roots[linked]])})

    placed = cells(points, _layout(points, shard_rows), reach, shard_rows)
    return placed.groupBy("shard", "i", "j").applyInArrow(stars, "a long, b long")


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """The smallest member reachable from every linked node: ``node, root``.

    Every round hangs all neighbours of a node, and the node, below the smallest of them:
    first the larger neighbours, then the smaller ones, until nothing moves. Rounds grow with
    the logarithm of the longest chain. Each is written to the shared folder.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")).withColumnRenamed("a", "of")
        large = both.join(low, F.col("a") == F.col("of")).where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low")).withColumnRenamed("a", "of")
        small = large.join(least, F.col("a") == F.col("of"))
        moved = small.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        after = written(moved.unionByName(least.select(F.col("of").alias("a"), F.col("low").alias("b"))).distinct(), "links")
        if _digest(after) == _digest(edges):
            break
        edges = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _classes(prints: DataFrame, order: Column, reach: int, shard_rows: int) -> DataFrame:
    """The least ``order`` value reachable from every fingerprint: ``of_fp, first``."""
    points = written(prints.groupBy("fp").agg(F.min(order).alias("first")), "points")
    roots = components(close_links(points, reach, shard_rows))
    joined = points.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    firsts = joined.groupBy("root").agg(F.min("first").alias("least")).withColumnRenamed("root", "r")
    return joined.join(firsts, F.col("root") == F.col("r")).select(F.col("fp").alias("of_fp"), F.col("least").alias("first"))


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, reach: int = DISTANCE, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """Fingerprint and group of every document: ``doc_id, fingerprint, component_id``.

    Fingerprints within ``reach`` bits are linked, and links join groups; ``component_id`` is
    the smallest id in the group. Equal fingerprints are first brought to one, so copies cost
    no pairs. Texts without words have the fingerprint zero. Null ids never name a group
    unless it has no other (then it is null); repeated rows each have a row; an empty table
    gives none; other columns are ignored.
    """
    prints = written(fingerprints(docs, shingle), "fingerprints")
    classes = _classes(prints, F.col("doc_id"), reach, shard_rows)
    return prints.join(classes, F.col("fp") == F.col("of_fp")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first").alias("component_id")
    )


def without_near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, reach: int = DISTANCE, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """One document of each group, the one with the smallest id, with all its columns.

    Equal ids are ordered by the hash of the row; of equal rows one stays. Null ids come last.
    Texts without words are one group; an empty table stays empty.
    """
    # Two hashes of the whole row name it; they are never null, so that the rows are dealt once
    # for the join and for dropping repeats.
    whole = hashable(docs, docs.columns)
    marks = [F.xxhash64(*whole).alias("mark"), F.xxhash64(F.lit(1), *whole).alias("mark2")]
    prints = written(fingerprints(docs, shingle, *marks), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "mark", "mark2")
    kept = _classes(prints, order, reach, shard_rows).select("first.mark", "first.mark2").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *marks)
    once = W.partitionBy("mark", "mark2").orderBy("mark")
    found = rows.join(kept, ["mark", "mark2"], "left_semi")
    return found.withColumn("turn", F.row_number().over(once)).where("turn = 1").select("row.*")
