"""Exact inner-product search with a ball tree per shard of vectors."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfline.llm.common import batches_of, prepare, written

K = 5
SCALE = 256
# Sums of whole numbers below it are exact in doubles, in any order.
EXACT = float(1 << 52)
SHARD_ROWS = 16_384
QUERY_ROWS = 2_048
LEAF_ROWS = 64
# Packed shards or blocks in one Arrow batch; each may hold some megabytes.
PACKED_ROWS = 2


def _norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows**2).sum(1))


def _whole_product(a: Sequence, b: Sequence) -> int:
    return sum(int(x) * int(y) for x, y in zip(a, b))


def _at_most(score: int) -> float:
    """A double that is not above a whole number."""
    if abs(score) < EXACT:
        return float(score)
    try:
        return float(np.nextafter(float(score), -np.inf))
    except OverflowError:
        return float(np.finfo(np.float64).max) if score > 0 else -np.inf


class BallTree:
    """Vectors in balls: every node has a centre and a radius, leaves hold few vectors.

    ``numbers`` tell rows of one id apart; ``wide`` has the exact components of vectors that
    are too long for doubles, by number.
    """

    def __init__(
        self, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF_ROWS, numbers: np.ndarray | None = None,
        wide: dict[int, list[int]] | None = None,
    ):
        self.order = np.arange(len(ids))
        self.rows, self.ids = rows.astype(np.float64), ids
        self.numbers, self.wide = ids if numbers is None else numbers, wide or {}
        self.spans: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        centres, radii = [], []
        todo = [(0, len(ids), None)]
        # Vectors may be too long for sums of squares in doubles; a ball of them is not split.
        while todo:
            a, b, above = todo.pop()
            own = self.rows[self.order[a:b]]
            centre = own.mean(0)
            node = len(self.spans)
            if above is not None:
                self.children[above] = (*(self.children[above] or ()), node)
            self.spans.append((a, b))
            self.children.append(None)
            centres.append(centre)
            radii.append(np.sqrt(((own - centre) ** 2).sum(1).max()))
            if b - a > leaf and radii[-1] > 0:
                # Split at the median along the direction from one far vector to another.
                far = own[((own - centre) ** 2).sum(1).argmax()]
                other = own[((own - far) ** 2).sum(1).argmax()]
                side = np.argsort(own @ (far - other), kind="stable")
                self.order[a:b] = self.order[a:b][side]
                middle = (a + b) // 2
                todo += [(a, middle, node), (middle, b, node)]
        self.centres, self.radii = np.array(centres), np.array(radii)
        self.rows, self.ids, self.numbers = self.rows[self.order], self.ids[self.order], self.numbers[self.order]
        self.norms = _norms(self.rows)
        self.reach = _norms(self.centres) + self.radii

    def search(
        self, queries: np.ndarray, own: np.ndarray, floors: np.ndarray, k: int, wide: dict[int, list[int]] | None = None
    ) -> tuple[list[tuple[int, int, int]], np.ndarray]:
        """The k best of this shard for each query that may still matter: (query, id, score).

        ``own`` has the numbers of the queries' own rows, which are left out; ``wide`` the
        exact components of those too long for doubles, by number.
        ``floors`` holds a score that the k-th best of each query reaches already; nodes
        whose bound is below it are left out, equal ones are not, since ties go to smaller
        ids. The new floors come back with the hits. Scores are exact: where doubles may
        round, they only tell which vectors are multiplied in whole numbers of any size.
        """
        queries, wide = queries.astype(np.float64), wide or {}
        lengths = _norms(queries)
        exact = (lengths * self.norms.max() < EXACT).tolist()
        # What rounding may change, as a part of the product of two lengths.
        part = 1e-12 + 1e-15 * queries.shape[1]
        # No vector of a ball scores above centre * q + radius * |q|; the slack covers rounding.
        bounds = queries @ self.centres.T + lengths[:, None] * self.radii[None, :]
        bounds += 1e-6 + part * lengths[:, None] * self.reach[None, :]
        bounds[np.isnan(bounds)] = np.inf
        hits, floors = [], floors.copy()
        for q in range(len(queries)):
            best: list[tuple[int, int]] = []  # (score, -id), smallest first
            floor = floors[q]
            nodes = [(-bounds[q, 0], 0)]
            while nodes:
                bound, node = heappop(nodes)
                if -bound < floor:
                    break
                below = self.children[node]
                if below:
                    for child in below:
                        if bounds[q, child] >= floor:
                            heappush(nodes, (-bounds[q, child], child))
                    continue
                a, b = self.spans[node]
                rows = self.rows[a:b]
                scores = rows @ queries[q]
                if exact[q]:
                    near = scores >= floor
                else:
                    most = lengths[q] * self.norms[a:b]
                    near = ~(scores + np.where(most < EXACT, 0.0, part * most) < floor)
                for i in np.nonzero(near)[0]:
                    number = int(self.numbers[a + i])
                    if number != own[q]:
                        if exact[q] or most[i] < EXACT:
                            score = int(scores[i])
                        else:
                            score = _whole_product(self.wide.get(number, rows[i]), wide.get(int(own[q]), queries[q]))
                        item = (score, -int(self.ids[a + i]))
                        if len(best) < k:
                            heappush(best, item)
                        elif item > best[0]:
                            heappop(best)
                            heappush(best, item)
                        if len(best) == k:
                            worst = best[0][0]
                            floor = max(floor, worst if exact[q] else _at_most(worst))
            floors[q] = floor
            hits += [(q, -i, s) for s, i in best]
        return hits, floors


def whole_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """Whole vectors: floor(scale * x) of every component as a double, in ``vec_id`` and ``v``.

    Vectors that are null, empty, or hold null or non-finite components take no part, nor do
    rows without an id. Where a component times ``scale`` is too large for a double, ``wide``
    has the components as they were; it is null elsewhere.
    """
    def whole_number(x: Column) -> Column:
        # Doubles from EXACT on have no fraction, and may be too large for a long.
        y = x.cast("double") * scale
        return F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)

    ints = F.transform("embedding", whole_number)
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = rows.where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(sound).where(F.size("embedding") > 0)
    whole = good.select(F.col("vec_id").cast("long").alias("vec_id"), ints.alias("v"), F.col("embedding").cast("array<double>").alias("x"))
    too_long = F.exists("v", lambda y: F.abs(y) == float("inf"))
    return whole.select("vec_id", "v", F.when(too_long, F.col("x")).alias("wide"))


_PACKED = "shard long, dims int, n int, ids binary, numbers binary, rows binary, wide string"


def _packed(vectors: DataFrame, per_shard: int) -> DataFrame:
    """Vectors in shards of about ``per_shard`` rows, each one row of bytes.

    They are dealt by ``row``, so that rows of one id spread over the shards.
    """
    total = vectors.select(F.count("*").alias("n")).scalar()
    shards = F.greatest(F.ceil(total / F.lit(float(per_shard))), F.lit(1)).cast("long")
    dealt = vectors.select(
        F.pmod(F.xxhash64("row", F.lit(6)), shards).alias("shard"), F.size("v").alias("dims"), "vec_id", "row", "v", "wide"
    )

    def pack(key: tuple, batch: pa.Table) -> pa.Table:
        ids, numbers = (
            np.concatenate([c.to_numpy(zero_copy_only=False) for c in batch.column(x).chunks]).astype(np.int64) for x in ("vec_id", "row")
        )
        dims = key[1].as_py()
        flat = pa.concat_arrays([c.flatten() for c in batch.column("v").chunks])
        rows = flat.to_numpy(zero_copy_only=False).reshape(-1, dims)
        if np.isfinite(rows).all() and np.abs(rows).max() < 1 << 31:
            rows = rows.astype(np.int32)
        long = np.nonzero(~np.isfinite(rows).all(axis=1))[0]
        # Whole numbers of any size, as text.
        wide = {str(numbers[i]): [str(int(x) * SCALE if np.isinf(y) else int(y)) for x, y in zip(batch.column("wide")[i].as_py(), rows[i].tolist())] for i in long.tolist()}
        order = np.argsort(ids, kind="stable")
        return pa.table(
            {
                "shard": pa.array([key[0].as_py()], pa.int64()), "dims": pa.array([dims], pa.int32()),
                "n": pa.array([len(ids)], pa.int32()), "ids": pa.array([ids[order].tobytes()], pa.binary()),
                "numbers": pa.array([numbers[order].tobytes()], pa.binary()),
                "rows": pa.array([rows[order].tobytes()], pa.binary()), "wide": pa.array([json.dumps(wide)], pa.string()),
            }
        )

    return dealt.groupBy("shard", "dims").applyInArrow(pack, _PACKED)


# ``place`` is that of the query in its block; several queries may have one id.
_ANSWERS = "block long, dims int, place int, query_id long, vec_id long, score long"


def top_k(
    rows: DataFrame, k: int = K, every: int = 50, per_shard: int = SHARD_ROWS, per_block: int = QUERY_ROWS
) -> DataFrame:
    """The k best inner products of every query: ``query_id, rank, vec_id, score``.

    Queries are the vectors whose id is divisible by ``every``; candidates are all rows but
    the query's own. Rows that repeat an id are queries, and candidates, of their own: each
    such query has its own k ranks.
    Vectors are packed into shards and queries into blocks, both of bounded size. First each
    block searches one shard, which gives every query a k-th score that its answer reaches;
    then all shards are searched below that bound, each by its own ball tree. A task takes
    its shards one after another, meets their blocks one at a time, and carries the k-th
    scores on. The answers of the shards are merged per query. Scores are exact for
    components of any size, those included that outgrow a double when scaled; an answer whose
    score does not fit a long is an error. Equal scores go to smaller
    ids; vectors of different lengths are not compared. A table with fewer candidates gives
    fewer rows, an empty one none.
    """
    spark = rows.sparkSession
    prepare(spark)
    whole = whole_vectors(rows)
    vectors = written(whole.withColumn("row", F.monotonically_increasing_id()), "vectors")
    shards = written(_packed(vectors, per_shard), "vector-shards")
    blocks = written(
        _packed(vectors.where(F.col("vec_id") % every == 0), per_block).select(
            F.col("shard").alias("block"), "dims", F.col("ids").alias("q_ids"), F.col("numbers").alias("q_numbers"),
            F.col("rows").alias("q_rows"), F.col("wide").alias("q_wide"),
        ),
        "query-blocks",
    )
    first = shards.groupBy("dims").agg(F.min("shard").alias("first"))
    # One shard per vector length, of per_shard rows at most about.
    start = shards.join(first, "dims").where("shard = first").drop("n", "first")
    with batches_of(spark, PACKED_ROWS):
        begun = written(blocks.join(F.broadcast(start), "dims").mapInArrow(_search_first(k), _ANSWERS), "first-answers")
    # Queries with k answers so far, with the worst of them.
    kth = begun.groupBy("block", "dims", "place").agg(F.count("score").alias("n"), F.min("score").alias("score")).where(F.col("n") == k)
    floors = written(kth.groupBy("block", "dims").applyInArrow(_pack_floors, "block long, dims int, floors binary"), "floors")
    rest = shards.join(first, "dims").where("shard <> first").drop("n", "first")
    # Every shard meets every block once: the stated query set against all rows, in blocks.
    asked = blocks.join(floors, ["block", "dims"], "left").join(rest.select("shard", "dims"), "dims")
    both = rest.unionByName(asked, allowMissingColumns=True).withColumn("asks", F.col("block").isNotNull())
    met = both.repartition("shard", "dims").sortWithinPartitions("shard", "dims", "asks", "block")
    with batches_of(spark, PACKED_ROWS):
        answers = written(met.mapInArrow(_search_rest(k), _ANSWERS), "answers").unionByName(begun)
    best = W.partitionBy("block", "dims", "place").orderBy(F.col("score").desc(), "vec_id")
    ranked = answers.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    score = F.coalesce("score", F.raise_error(F.lit("a score among the best does not fit a long")).cast("long"))
    return ranked.select("query_id", "rank", "vec_id", score.alias("score"))


def _pack_floors(key: tuple, batch: pa.Table) -> pa.Table:
    places, scores = (
        np.concatenate([c.to_numpy(zero_copy_only=False) for c in batch.column(x).chunks]) for x in ("place", "score")
    )
    packed = np.stack([places, scores], 1).astype(np.int64).tobytes()
    return pa.table(
        {"block": pa.array([key[0].as_py()], pa.int64()), "dims": pa.array([key[1].as_py()], pa.int32()),
         "floors": pa.array([packed], pa.binary())}
    )


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch.column(c)[i].as_py() for c in batch.schema.names}


def _unpacked(rows: bytes, n: int, dims: int) -> np.ndarray:
    """Vectors are packed as 4-byte whole numbers, or as doubles where those are too small."""
    return np.frombuffer(rows, np.int32 if len(rows) == 4 * n * dims else np.float64).reshape(-1, dims)


def _wide(text: str) -> dict[int, list[int]]:
    return {int(number): [int(x) for x in v] for number, v in json.loads(text).items()}


def _tree(row: dict) -> BallTree:
    ids, numbers = (np.frombuffer(row[x], np.int64) for x in ("ids", "numbers"))
    return BallTree(ids, _unpacked(row["rows"], len(ids), row["dims"]), numbers=numbers, wide=_wide(row["wide"]))


def _long(score: int) -> int | None:
    """A score as a long; none for one below all longs, which may yet be left out of the answer."""
    if score >= 1 << 63:
        raise OverflowError(f"a score among the best does not fit a long: {score}")
    return score if score >= -1 << 63 else None


def _answers(tree: BallTree, row: dict, floors: np.ndarray | None, k: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """Search a block of queries in a shard; also the floors of the block from now on."""
    q_ids = np.frombuffer(row["q_ids"], np.int64)
    queries = _unpacked(row["q_rows"], len(q_ids), row["dims"])
    if floors is None:
        floors = np.full(len(q_ids), -np.inf)
        if row.get("floors"):
            known = np.frombuffer(row["floors"], np.int64).reshape(-1, 2)
            floors[known[:, 0]] = [_at_most(x) for x in known[:, 1].tolist()]
    hits, floors = tree.search(queries, np.frombuffer(row["q_numbers"], np.int64), floors, k, _wide(row["q_wide"]))
    found = pa.RecordBatch.from_arrays(
        [
            pa.array([row["block"]] * len(hits), pa.int64()), pa.array([row["dims"]] * len(hits), pa.int32()),
            pa.array([q for q, _, _ in hits], pa.int32()), pa.array([int(q_ids[q]) for q, _, _ in hits], pa.int64()),
            pa.array([v for _, v, _ in hits], pa.int64()), pa.array([_long(s) for _, _, s in hits], pa.int64()),
        ],
        ["block", "dims", "place", "query_id", "vec_id", "score"],
    )
    return found, floors


def _search_first(k: int):
    """Each row holds a block of queries and the first shard of their length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[int, BallTree] = {}
        for row in _rows_of(batches):
            if row["dims"] not in trees:
                trees = {row["dims"]: _tree(row)}
            yield _answers(trees[row["dims"]], row, None, k)[0]

    return run


def _search_rest(k: int):
    """A shard comes first, then the blocks that are sought in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, floors = None, {}
        for row in _rows_of(batches):
            if not row["asks"]:
                tree = _tree(row)
                continue
            block = (row["dims"], row["block"])
            found, floors[block] = _answers(tree, row, floors.get(block), k)
            yield found

    return run
