"""What the corpus operators share: word classes, Arrow batches and distributed ranks."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.session import scratch_dir

# Separators of lower-cased ASCII words; every other character belongs to a word.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# One byte table for the same rule: upper case to lower case, separators to spaces.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
# Rows that one task ranks by sorting; cells hold about this many.
ROWS_PER_CELL = 4_000
# Rows of one Arrow batch; the longest texts decide how much memory it takes.
BATCH_ROWS = 256
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepare(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Settings for functions on Arrow batches.

    Batches hold few texts, so that long ones fit a Python worker; and workers look for this
    package where the driver has it, besides where they look anyway.
    """
    spark.conf.set(_BATCH, str(rows))
    here, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = known.get("PYTHONPATH", "").split(os.pathsep)
    if here not in paths:
        known["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), here])


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of another size for what is run, not only planned, inside."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def over_batches(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str | T.StructType
) -> DataFrame:
    """Apply a function to every Arrow batch; ``make`` prepares it once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    prepare(df.sparkSession)
    return df.mapInArrow(run, schema)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table to the shared folder once and read it back.

    It survives lost executors and lets later passes read only the columns they need. Texts
    are the bulk of it, so it is packed more tightly than Spark does by default.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, label: str) -> DataFrame:
    """Write rows once with a number of their own, ``rid``; what is read back keeps it."""
    return written(df.withColumn("rid", F.monotonically_increasing_id()), label)


def with_rows(found: DataFrame, rows: DataFrame) -> DataFrame:
    """Bring what was found by number together with the whole rows.

    Rows are shuffled once and not sorted; the narrow side is hashed, a partition at a time.
    """
    return rows.select("rid", "row").join(found.hint("shuffle_hash"), "rid").drop("rid")


def hashable(df: DataFrame, names: list[str]) -> list[Column]:
    """Columns as Spark can hash them: those with maps as JSON, others as they are."""
    kinds = dict(df.dtypes)
    return [F.to_json(F.struct(f"`{c}`")) if "map<" in kinds[c] else F.col(f"`{c}`") for c in names]


def order_key(seed: int, column: Column) -> Column:
    """A text key that puts rows into a fixed random order; the same in any SQL engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(column.cast("string"), F.lit(""))).cast("binary"))


def unit(key: Column) -> Column:
    """The position of a hexadecimal key between 0 and 1, in the order of the keys."""
    return F.conv(F.substring(key, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


# Cells whose sums one task adds up in order.
CELLS_TOGETHER = 4_096


def tie_place(tie: Column) -> Column:
    """The position of a hashed long between 0 and 1, in the order of the longs."""
    return F.least(F.greatest(tie.cast("double") / F.lit(2.0**64) + 0.5, F.lit(0.0)), F.lit(1 - 2.0**-53))


def before_in_group(
    rows: DataFrame, group: list[str], key: str, order: list[str], sums: dict[str, str],
    per_group: DataFrame | None = None, place: Column | None = None, lead: tuple[str, ...] = (), within: Column | None = None,
) -> DataFrame:
    """Running sums ahead of every row of its group, and the group's totals.

    ``key`` leads the order, and ``place`` is its position between 0 and 1 (``key`` is a
    random hexadecimal key by default). Rows fall into cells by their place, cells are summed
    ahead of the shuffle, and only rows of one cell are sorted together, so a group of any
    size spreads over many tasks. ``sums`` maps a value column to a name: ``<name>_before``
    and ``<name>_total`` are added. Group columns must not be null. ``per_group`` has one row
    per group, whose other columns are added by way of the cells, so that no join deals the
    rows by their group alone.

    A key that more rows share than a cell should hold, such as a null id, stands in its cell
    as one row; its own rows are ranked by the columns ``lead`` and then in cells by
    ``within``, a position that the rest of the order agrees with (by default that of the
    hash that ends it).
    """
    place = unit(F.col(key)) if place is None else place
    within = tie_place(F.col(order[-1])) if within is None else within
    named = [*group, key]
    hot = rows.groupBy(*named).agg(F.count("*").alias("hot_rows")).where(F.col("hot_rows") > ROWS_PER_CELL)
    hot = written(hot.withColumnsRenamed({c: f"hot_{c}" for c in named}), "hot-keys")
    total = rows.select(F.count("*").alias("n")).scalar()
    if hot.isEmpty():
        return _by_cells(rows, group, key, order, sums, per_group, place, total)
    same = [F.col(c) == F.col(f"hot_{c}") for c in named]
    crowd = written(rows.join(hot.drop("hot_rows"), same).drop(*[f"hot_{c}" for c in named]), "hot-rows")
    alone = rows.join(hot, same, "left_anti").withColumn("stands", F.lit(False))
    stand = crowd.groupBy(*named).agg(*[F.sum(v).alias(v) for v in sums]).withColumn("stands", F.lit(True))
    both = alone.unionByName(stand, allowMissingColumns=True)
    placed = written(_by_cells(both, group, key, order, sums, per_group, place, total), "ranked-keys")
    more = [c for c in placed.columns if c not in both.columns]
    base = placed.where("stands").select(*[F.col(c).alias(f"at_{c}") for c in named], *more)
    ranked = _in_crowds(crowd, named, order, sums, lead, within).join(base, [F.col(c) == F.col(f"at_{c}") for c in named])
    ranked = ranked.withColumns({f"{n}_before": F.col(f"{n}_before") + F.col(f"{n}_inside") for n in sums.values()})
    kept = [*rows.columns, *more]
    return placed.where("NOT stands").select(kept).unionByName(ranked.select(kept))


def _in_crowds(
    crowd: DataFrame, named: list[str], order: list[str], sums: dict[str, str], lead: tuple[str, ...], within: Column
) -> DataFrame:
    """``<name>_inside``: running sums ahead of every row among the rows of its key."""
    ahead = W.partitionBy(*named).orderBy(*lead or named).rowsBetween(W.unboundedPreceding, W.currentRow)
    heads = crowd.groupBy(*named, *lead).agg(F.count("*").alias("of_rows"), *[F.sum(v).alias(f"{n}_head") for v, n in sums.items()])
    heads = heads.select(
        *[F.col(c).alias(f"of_{c}") for c in [*named, *lead]], "of_rows",
        *[(F.sum(f"{n}_head").over(ahead) - F.col(f"{n}_head")).alias(f"{n}_head") for n in sums.values()],
    )
    split = crowd.join(heads, [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in [*named, *lead]])
    split = split.drop(*[f"of_{c}" for c in [*named, *lead]]).withColumn(
        "sub", F.floor(within * F.ceil(F.col("of_rows") / F.lit(float(ROWS_PER_CELL)))).cast("long")
    )
    split = written(split, "hot-cells")
    cell = [*named, *lead, "sub"]
    in_order = W.partitionBy(*named, *lead).orderBy("sub").rowsBetween(W.unboundedPreceding, W.currentRow)
    subs = split.groupBy(*cell).agg(*[F.sum(v).alias(f"{n}_sub") for v, n in sums.items()])
    subs = subs.select(
        *[F.col(c).alias(f"of_{c}") for c in cell],
        *[(F.sum(f"{n}_sub").over(in_order) - F.col(f"{n}_sub")).alias(f"{n}_sub") for n in sums.values()],
    )
    inside = W.partitionBy(*cell).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    split = split.withColumns({f"{n}_own": F.sum(v).over(inside) - F.col(v) for v, n in sums.items()})
    split = split.join(subs, [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in cell])
    return split.withColumns({f"{n}_inside": F.col(f"{n}_head") + F.col(f"{n}_sub") + F.col(f"{n}_own") for n in sums.values()})


def _by_cells(
    rows: DataFrame, group: list[str], key: str, order: list[str], sums: dict[str, str], per_group: DataFrame | None,
    place: Column, total: Column,
) -> DataFrame:
    cells = F.greatest(F.ceil(total / F.lit(float(ROWS_PER_CELL))), F.lit(1)).cast("long")
    placed = rows.withColumn("cell", F.floor(place * cells).cast("long"))
    # Cells are added up in order within blocks of cells, and the blocks in order.
    whole, block = W.partitionBy(*group), [*group, "block"]
    sofar = lambda w: w.rowsBetween(W.unboundedPreceding, W.currentRow)
    starts = placed.groupBy(*group, "cell").agg(*[F.sum(v).alias(f"{n}_cell") for v, n in sums.items()])
    starts = starts.withColumn("block", F.expr(f"cell div {CELLS_TOGETHER}"))
    blocks = starts.groupBy(*block).agg(*[F.sum(f"{n}_cell").alias(f"{n}_block") for n in sums.values()])
    blocks = blocks.select(
        *[F.col(c).alias(f"in_{c}") for c in block],
        *[(F.sum(f"{n}_block").over(sofar(whole.orderBy("block"))) - F.col(f"{n}_block")).alias(f"{n}_ahead") for n in sums.values()],
        *[F.sum(f"{n}_block").over(whole).alias(f"{n}_total") for n in sums.values()],
    )
    starts = starts.join(blocks, [F.col(c) == F.col(f"in_{c}") for c in block])
    in_block = sofar(W.partitionBy(*block).orderBy("cell"))
    starts = starts.select(
        *[F.col(c).alias(f"at_{c}") for c in [*group, "cell"]],
        *[(F.col(f"{n}_ahead") + F.sum(f"{n}_cell").over(in_block) - F.col(f"{n}_cell")).alias(f"{n}_start") for n in sums.values()],
        *[f"{n}_total" for n in sums.values()],
    )
    if per_group is not None:
        named = per_group.withColumnsRenamed({c: f"of_{c}" for c in group})
        starts = starts.join(named, [F.col(f"at_{c}") == F.col(f"of_{c}") for c in group]).drop(*[f"of_{c}" for c in group])
    inside = sofar(W.partitionBy(*group, "cell").orderBy(key, *order))
    ranked = placed.withColumns({f"{n}_inside": F.sum(v).over(inside) - F.col(v) for v, n in sums.items()})
    joined = ranked.join(starts, [F.col(c) == F.col(f"at_{c}") for c in [*group, "cell"]])
    joined = joined.withColumns({f"{n}_before": F.col(f"{n}_start") + F.col(f"{n}_inside") for n in sums.values()})
    helpers = [f"{n}_{x}" for n in sums.values() for x in ("start", "inside")]
    return joined.drop("cell", *helpers, *[f"at_{c}" for c in [*group, "cell"]])
