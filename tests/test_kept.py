"""Kept sketches, job snapshots, hours with late rows, and shared report tables."""

from __future__ import annotations

import random
import threading
from datetime import date, datetime, timedelta

import pytest

from shelfline.operators import jobs, sketches
from shelfline.plans import reports
from shelfline.streaming import arrivals, hours

LOG = "job_id int, search_term string, status string, event_time timestamp, message string"


def _log(n=300, seed=2):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    states = ["pending", "running", "completed", "failed", "cancelled"]
    return [
        (j, f"t{j}", rng.choice(states), start + timedelta(minutes=rng.randint(0, 40)), rng.choice([None, "m1", "m2"]))
        for j in (rng.randint(0, 40) for _ in range(n))
    ]


@pytest.mark.parametrize("cut", [0, 1, 150, 299, 300])
def test_snapshot_and_tail_equal_the_whole_log(spark, tmp_path, cut):
    log = _log()
    log += log[:20]  # repeated entries
    whole = {tuple(r) for r in jobs.latest_jobs(spark.createDataFrame(log, LOG)).collect()}
    path = str(tmp_path / "snapshot")
    jobs.job_states(spark.createDataFrame(log[:cut], LOG)).write.parquet(path)
    snapshot, tail = spark.read.parquet(path), spark.createDataFrame(log[cut:], LOG)
    assert {tuple(r) for r in jobs.latest_jobs(tail, snapshot).collect()} == whole
    # Snapshots merge in any order, and entries that both hold count once.
    both = jobs.merged_states(jobs.job_states(tail), jobs.job_states(spark.createDataFrame(log, LOG)), snapshot)
    assert {tuple(r) for r in jobs.jobs_of(both).collect()} == whole


def test_sketches_of_any_span(spark):
    rows = [("a" if i % 3 else "b", f"n{i % 70}", float(i % 101) if i % 10 else None, date(2024, 1, 1 + i % 9)) for i in range(5000)]
    rows += [("c", "only", None, date(2024, 1, 1)), (None, None, 1.0, None)]
    df = spark.createDataFrame(rows, "search_term string, name string, price_numeric double, scrape_date date")
    daily = sketches.daily_sketches(df)
    for first, last in ((None, None), ("2024-01-02", "2024-01-05"), ("2024-01-03", None)):
        days = [r for r in rows if r[3] is not None or first is last is None]
        days = [r for r in days if (not first or r[3] >= date.fromisoformat(first)) and (not last or r[3] <= date.fromisoformat(last))]
        got = sketches.distinct_of_sketches(sketches.percentiles_of_sketches(sketches.merged(daily, ["search_term"], first, last), {"p50": 0.5}))
        for r in got.collect():
            own = [x for x in days if x[0] == r.search_term]
            prices = [x[2] for x in own if x[2] is not None]
            assert (r.listings, r.priced) == (len(own), len(prices))
            assert r.distinct_names == len({x[1] for x in own if x[1] is not None})
            if prices:
                below = sum(p <= r.p50 for p in prices) / len(prices)
                assert below >= 0.48 and sum(p < r.p50 for p in prices) / len(prices) <= 0.52
            else:
                assert r.p50 is None
    shared = {r.search_term: r.shared_names for r in sketches.overlaps(daily, "search_term", "a").where("search_term IS NOT NULL").collect()}
    assert shared == {"a": 70, "b": 70, "c": 0}
    assert sketches.merged(daily.where("1 = 0"), ["search_term"]).count() == 0


def test_hours_and_late_rows_are_all_rows(spark, tmp_path):
    files, out, progress = (str(tmp_path / x) for x in ("files", "out", "progress"))
    schema = "scrape_time string, price_numeric double, id int"
    batches = [
        [("2024-01-01 10:05:00", 1.0, 1), ("2024-01-01 12:30:00", None, 2), (None, 5.0, 3)],
        [("2024-01-01 09:59:59", 2.0, 4), ("2024-01-01 10:59:59", 3.0, 5), ("2024-01-01 15:00:00", 4.0, 6)],
        [("2024-01-01 12:00:00", 9.0, 7), ("2024-01-01 13:00:00", 6.0, 8), ("2024-01-01 12:59:59", 9.0, 9)],
    ]
    like = spark.createDataFrame([], schema)
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(files)
        hours.count_hours(arrivals.arriving(spark, files, like.schema), out, progress).awaitTermination()
    got = {r.hour_start.hour: (r.listings, r.priced, r.mean_price, r.closed) for r in hours.hours(spark, out).collect()}
    # After the first batch all before 10:30 is closed, after the second all before 13:00.
    assert got == {10: (2, 2, 2.0, True), 12: (1, 0, None, True), 13: (1, 1, 6.0, False), 15: (1, 1, 4.0, False)}
    assert {r.id for r in hours.late_rows(spark, out, like).collect()} == {3, 4, 7, 9}
    assert hours.hours(spark, str(tmp_path / "none")).count() == 0 and hours.late_rows(spark, str(tmp_path / "none"), like).count() == 0


def test_shared_tables_are_made_once(spark, monkeypatch):
    made = []
    keep = reports.materialise
    monkeypatch.setattr(reports, "materialise", lambda df, label: made.append(label) or keep(df, label))
    rows = [("n", "x", float(i), datetime(2024, 1, 1 + i % 3)) for i in range(9)]
    df = spark.createDataFrame(rows, "name string, search_term string, price_numeric double, scrape_time timestamp")
    report = reports.Report(df)
    workers = [threading.Thread(target=lambda: (report.marks, report.averages, report.prices)) for _ in range(6)]
    for w in workers:
        w.start()
    for w in workers:
        w.join()
    assert sorted(made) == ["averages", "marks", "price-cells"]
    report.release()
    assert report.prices.count() == 9 and made.count("price-cells") == 2
