"""The index of stored links, and streams with state bounded in time."""

from __future__ import annotations

import re
import time

import pytest
from pyspark.sql import functions as F

from shelfline.operators import ingest, links
from shelfline.streaming import arrivals, seen

ROW = "link string, name string, scrape_time string, n long"


def rows_of(spark, names, day, start=0):
    return spark.createDataFrame([(x, f"{x} {day}", f"2024-01-{day:02d}T00:00:00", start + i) for i, x in enumerate(names)], ROW)


def stored(spark, store):
    return sorted((r.link or "", r.name) for r in ingest.read_store(spark, store, _schema(spark)).collect())


def _schema(spark):
    return spark.createDataFrame([], ROW).schema


@pytest.mark.parametrize("buckets", [1, 7, 64])
def test_indexed_batches_equal_plain_ones(spark, tmp_path, buckets):
    plain, store = str(tmp_path / "plain"), str(tmp_path / "store")
    index = links.LinkIndex(spark, str(tmp_path / "index"), buckets)
    names = [f"http://x/{i}" for i in range(40)]
    batches = [names[:20] + [None, names[3]], names[10:30] + [None, ""], names[25:] + ["", None], []]
    for day, batch in enumerate(batches, 1):
        df = rows_of(spark, batch, day)
        for _ in range(2):  # a repeat replaces its own rows
            ingest.write_batch(df, plain, f"b{day}", ["n"])
            links.write_indexed(df, store, index, f"b{day}", ["n"])
        assert stored(spark, store) == stored(spark, plain)
    assert index.links().count() == 41 and index.links().select("link").distinct().count() == 41
    # Opened again, the index keeps its number of buckets.
    assert links.LinkIndex(spark, str(tmp_path / "index"), buckets + 5).buckets == buckets


def _bucket_filters(df):
    plan = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return re.findall(r"PartitionFilters: \[.*bucket.*\]", plan)


def test_only_touched_buckets_are_read(spark, tmp_path):
    index = links.LinkIndex(spark, str(tmp_path / "index"), 64)
    many = spark.range(2000).select(F.concat(F.lit("http://x/"), "id").alias("link"), F.lit("all").alias("batch_id"))
    index.add(many)
    keyed = many.where("link IN ('http://x/5', 'http://x/77')").select("link", index._bucket().alias("bucket"), index._mark().alias("mark"))
    buckets = {r.bucket for r in keyed.collect()}
    assert _bucket_filters(index.perhaps(keyed))
    # Files of other buckets could not be read.
    for file in (tmp_path / "index").rglob("*.parquet"):
        if (bucket := re.search("bucket=([0-9]+)/", str(file))) and int(bucket[1]) not in buckets:
            file.write_bytes(b"no parquet")
    asked = many.where("link IN ('http://x/5', 'http://x/77')").drop("batch_id")
    assert index.unseen(asked).count() == 0
    # New links of those buckets read the sketches there, and no links.
    new = spark.range(2000, 4000).select(F.concat(F.lit("http://x/"), "id").alias("link"))
    new = new.where(index._bucket().isin(sorted(buckets)))
    for file in (tmp_path / "index" / "links").rglob("*.parquet"):
        file.write_bytes(b"no parquet")
    assert index.unseen(new).count() == new.count() > 20


def test_equal_marks_are_told_apart(spark, tmp_path, monkeypatch):
    # A sketch that cannot tell any two links apart costs reading, not results.
    monkeypatch.setattr(links.LinkIndex, "_mark", lambda self: F.length(self.link) * 0)
    index = links.LinkIndex(spark, str(tmp_path / "index"), 3)
    index.add(spark.createDataFrame([("a", "1"), ("b", "1"), (None, "1")], "link string, batch_id string"))
    asked = spark.createDataFrame([("a", 1), ("c", 2), ("c", 3), (None, 4)], "link string, n int")
    assert sorted(r.n for r in index.unseen(asked).collect()) == [2, 3, 4]
    assert [r.n for r in index.unseen(asked.where("n = 1"), "1").collect()] == [1]


def test_an_index_catches_up_with_its_store_and_is_compacted(spark, tmp_path):
    store = str(tmp_path / "store")
    for day in (1, 2, 3):
        ingest.write_batch(rows_of(spark, [f"l{day}", "l0", None], day).drop("n").withColumn("price", F.lit(1.0)), store, f"b{day}")
    index = links.indexed(spark, store, str(tmp_path / "index"), 5)
    assert sorted(r.link for r in index.links().collect()) == ["l0", "l1", "l2", "l3"]
    assert links.indexed(spark, store, str(tmp_path / "index"), 5).links().count() == 4
    small = index.compacted(str(tmp_path / "compacted"))
    assert {tuple(r) for r in small.marks().select("mark", "bucket").collect()} == {tuple(r) for r in index.marks().select("mark", "bucket").collect()}
    assert small.marks().select("batch_id").distinct().count() == 1
    assert small.unseen(rows_of(spark, ["l0", "new", None], 4)).count() == 2


def _stream(spark, files, store, index, progress, ttl):
    """Run what has arrived; the number of entries that are left in the state."""
    stream = arrivals.arriving(spark, files, _schema(spark))
    query = seen.first_links_in_time(stream, store, index, progress, ["n"], ttl=ttl)
    query.awaitTermination()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    return kept[-1] if kept else 0


def test_state_holds_links_for_their_time_only(spark, tmp_path):
    files, store, progress = (str(tmp_path / x) for x in ("files", "store", "progress"))
    index = links.LinkIndex(spark, str(tmp_path / "index"), 4)

    def arrive(names, day):
        rows_of(spark, names, day).coalesce(1).write.mode("append").parquet(files)
        kept = _stream(spark, files, store, index, progress, "2 seconds")
        time.sleep(3)
        return kept

    assert arrive([f"a{i}" for i in range(30)] + ["a1", None, None], 5) == 30
    # Restarts: what arrived two runs ago is forgotten.
    arrive([f"b{i}" for i in range(10)] + ["a1", "a2", None], 3)
    assert arrive(["c", "a3"], 2) <= 14
    # Links that expired were looked up in the index and not stored again; older rows came too late for them.
    got = stored(spark, store)
    assert len(got) == 30 + 10 + 1 + 3 and ("a1", "a1 5") in got and not [n for _, n in got if n in ("a1 3", "a2 3", "a3 2")]
    # Without anything new nothing is added.
    _stream(spark, files, store, index, progress, "2 seconds")
    assert stored(spark, store) == got


def test_links_in_the_state_are_not_looked_up(spark, tmp_path, monkeypatch):
    files, store, progress = (str(tmp_path / x) for x in ("files", "store", "progress"))
    index = links.LinkIndex(spark, str(tmp_path / "index"), 4)
    asked = []
    unseen = links.LinkIndex.unseen
    monkeypatch.setattr(links.LinkIndex, "unseen", lambda self, rows, batch=None: asked.append(sorted(r.link or "" for r in rows.collect())) or unseen(self, rows, batch))
    for names in (["a", "b", None], ["b", "c", "b"]):
        rows_of(spark, names, 1).coalesce(1).write.mode("append").parquet(files)
        _stream(spark, files, store, index, progress, "3650 days")
    assert [x for x in asked if x] == [["", "a", "b"], ["c"]]


def test_the_first_row_in_order_passes(spark, tmp_path):
    files, store, progress = (str(tmp_path / x) for x in ("files", "store", "progress"))
    index = links.LinkIndex(spark, str(tmp_path / "index"), 4)
    rows = spark.createDataFrame([("a", "late", "2024-02-01", 3), ("a", "early", "2024-01-01", 9), ("a", "none", None, 9), ("b", "x", None, None), ("b", "y", None, 1)], ROW)
    rows.repartition(3).write.parquet(files)
    stream = arrivals.arriving(spark, files, rows.schema)
    seen.first_links_in_time(stream, store, index, progress, ["scrape_time", "n"]).awaitTermination()
    assert stored(spark, store) == [("a", "none"), ("b", "x")]
