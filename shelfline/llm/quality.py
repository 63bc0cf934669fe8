"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import over_batches

# Most labelled documents that the trees are fitted on, chosen by a hash of their id.
TRAINING_ROWS = 20_000
FOLDS, HELD_OUT = 3, 1

_BYTES = np.arange(256)
_KINDS = np.stack(
    [
        ((_BYTES >= 65) & (_BYTES <= 90)),
        ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128),
        ((_BYTES >= 48) & (_BYTES <= 57)),
        np.isin(_BYTES, list(b" \t\r\f\v")),
        _BYTES == 10,
        np.isin(_BYTES, list(b".,;:'\"()")),
        np.isin(_BYTES, list(b"!?")),
        np.isin(_BYTES, list(b"|/\\-_=+<>[]{}")),
        np.isin(_BYTES, list(b"#*%$&@^~`")),
    ]
).astype(np.float64)
N_STATISTICS = len(_KINDS) + 9


def statistics(text: str | None) -> list[float]:
    """Numbers that describe a text: kinds of characters, words, lines and repetition."""
    text = text or ""
    counts = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    shares = (_KINDS @ counts) / max(1, counts.sum())
    words = text.split()
    lines = [x for x in text.split("\n") if x]
    n, k = max(1, len(words)), max(1, len(lines))
    return [
        *shares.tolist(),
        float(np.log1p(len(words))),
        len(text) / n,
        len(set(words)) / n,
        len(set(lines)) / k,
        len(words) / k,
        float(np.log1p(len(lines))),
        max(map(len, words), default=0),
        sum(1 for x in lines if len(x) < 20) / k,
        sum(1 for w in words if not w[-1].isalnum()) / n,
    ]


@dataclass
class Trees:
    """All trees in flat arrays: node i splits on ``feature[i]`` at ``threshold[i]``; leaves
    point to themselves, so every row walks the same number of steps."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        raw = np.full(len(rows), self.base)
        at_row = np.arange(len(rows))
        for root in self.roots:
            node = np.full(len(rows), root)
            for _ in range(self.depth):
                goes_left = rows[at_row, self.feature[node]] <= self.threshold[node]
                node = np.where(goes_left, self.left[node], self.right[node])
            raw += self.value[node]
        return 1.0 / (1.0 + np.exp(-raw))


def fit(
    rows: np.ndarray, labels: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.2,
    ridge: float = 1.0, least: float = 1.0,
) -> Trees:
    """Boost trees on the logistic loss, with splits sought in histograms of the statistics.

    Without labels, or with labels of one kind only, there are no trees: every score is the
    smoothed share of label 1.
    """
    labels = np.asarray(labels, float)
    share = (labels.sum() + 1.0) / (len(labels) + 2.0)
    base = float(np.log(share / (1.0 - share)))
    nodes: list[list] = []
    roots: list[int] = []
    if len(set(labels.tolist())) == 2:
        edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(rows.shape[1])]
        binned = np.stack([np.searchsorted(e, rows[:, f], side="left") for f, e in enumerate(edges)], 1)
        width = max(len(e) for e in edges) + 1
        raw = np.full(len(labels), base)
        for _ in range(trees):
            p = 1.0 / (1.0 + np.exp(-raw))
            grad, hess = p - labels, p * (1.0 - p)
            roots.append(_grow(nodes, np.arange(len(labels)), binned, edges, width, grad, hess, raw, depth, rate, ridge, least))
    table = np.array(nodes, float).reshape(-1, 5)
    return Trees(
        base, np.array(roots, int), table[:, 0].astype(int), table[:, 1], table[:, 2].astype(int), table[:, 3].astype(int),
        table[:, 4], depth,
    )


def _grow(nodes, rows, binned, edges, width, grad, hess, raw, depth, rate, ridge, least) -> int:
    """Add the tree for some rows to ``nodes`` and to the running scores; returns its root."""
    at = len(nodes)
    g, h = grad[rows].sum(), hess[rows].sum()
    nodes.append([0, 0.0, at, at, -rate * g / (h + ridge)])
    best = None
    if depth:
        for f, cuts in enumerate(edges):
            if not len(cuts):
                continue
            own = binned[rows, f]
            gl = np.bincount(own, grad[rows], width).cumsum()[: len(cuts)]
            hl = np.bincount(own, hess[rows], width).cumsum()[: len(cuts)]
            gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
            gain[(hl < least) | (h - hl < least)] = 0.0
            k = int(gain.argmax())
            if gain[k] > 1e-6 and (best is None or gain[k] > best[0] + 1e-12):
                best = (gain[k], f, k)
    if best is None:
        raw[rows] += nodes[at][4]
        return at
    _, f, k = best
    goes_left = binned[rows, f] <= k
    left = _grow(nodes, rows[goes_left], binned, edges, width, grad, hess, raw, depth - 1, rate, ridge, least)
    right = _grow(nodes, rows[~goes_left], binned, edges, width, grad, hess, raw, depth - 1, rate, ridge, least)
    nodes[at][:4] = [f, edges[f][k], left, right]
    return at


def held_out(doc_id: Column) -> Column:
    """Rows that never serve for fitting; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def fitted(docs: DataFrame, labels: DataFrame, training_rows: int = TRAINING_ROWS) -> Trees:
    """Fit on labelled documents outside the held-out fold.

    At most ``training_rows`` labels are used, those with the smallest hash of their id; only
    the statistics of their documents come to the driver. Null labels and null ids are left
    out; of contradicting labels of one id the smaller counts, and every repeated document
    of an id is a training row of its own within the bound.
    """
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(training_rows)
    # At most training_rows rows of two numbers: no text is shuffled to meet them.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [statistics(t) for t in batch.column(2).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.string()), batch.column(1).cast(pa.int64()), pa.array(found, pa.list_(pa.float64()))],
                ["doc_id", "quality", "found"],
            )

        return run

    got = over_batches(rows, make, "doc_id string, quality long, found array<double>")
    local = got.orderBy("doc_id", "quality", "found").limit(training_rows).toArrow()
    data = np.array(local.column("found").to_pylist(), float).reshape(-1, N_STATISTICS)
    return fit(data, (np.array(local.column("quality").to_pylist(), int).reshape(-1) > 0).astype(int))


def _scores(model: Trees, texts: Sequence[str | None]) -> np.ndarray:
    return model.scores(np.array([statistics(t) for t in texts], float).reshape(-1, N_STATISTICS))


def quality_scores(docs: DataFrame, labels: DataFrame, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """Score every whole text: ``doc_id, held_out, score, predicted``.

    ``score`` is the probability of label 1, also for null or empty texts, whose statistics
    are zero; ``predicted`` is 1 from one half on. Without usable labels every score is one
    half. Repeated rows are scored one by one; an empty table gives no rows; languages,
    sources, ids and other columns play no part.
    """
    model = fitted(docs, labels, training_rows)

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores = _scores(model, batch.column(2).to_pylist())
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

        return run

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return over_batches(rows, make, f"doc_id {kind}, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, labels: DataFrame, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """The documents that the classifier accepts, with all their columns.

    Null and empty texts are scored like any other; repeated rows are kept or dropped alike.
    Without usable labels everything is accepted, an empty table stays empty. Further columns
    of any name stay as they are; the text is found by its name in any case.
    """
    model = fitted(docs, labels, training_rows)

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch.filter(pa.array(_scores(model, batch.column(0).to_pylist()) >= 0.5))

        return run

    # Rows are carried as one column beside the text, so that no name can clash.
    rows = docs.select(F.col("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return over_batches(rows, make, rows.schema).select("row.*")
