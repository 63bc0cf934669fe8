"""Large JSON arrays read by many tasks, against the whole-file reader."""

from __future__ import annotations

import json
import random
from collections import Counter

import pytest
from pyspark.sql import types as T

from shelfline.queries.scans import s4_split_item_arrays
from shelfline.session import materialise
from shelfline.sources import arrays
from shelfline.sources.arrays import read_array_items
from shelfline.sources.listings import read_items

SCHEMA = T.StructType([T.StructField("name", T.StringType()), T.StructField("n", T.LongType()), T.StructField("tags", T.ArrayType(T.StringType())), T.StructField("more", T.MapType(T.StringType(), T.StringType()))])


def _items(n, seed=1):
    rng = random.Random(seed)
    odd = ['{', '}', '"', "\\", "[", "]", ",", "\n", "é\U0001f600", "x", " ", '\\"', "}{", "{\"a\": 1}"]
    word = lambda k: "".join(rng.choice(odd) for _ in range(rng.randint(0, k)))
    return [
        {"name": word(9) + "x", "n": rng.randint(0, 99), "tags": [word(3) for _ in range(rng.randint(0, 3))], "more": {word(2) + "k": word(4)}}
        for _ in range(n)
    ]


def _rows(df):
    return Counter(json.dumps(r.asDict(recursive=True), sort_keys=True) for r in df.collect())


def _told(items):
    return Counter(json.dumps(i, sort_keys=True) for i in items)


@pytest.mark.parametrize("split", [700, 1 << 20])
def test_items_equal_the_whole_file(spark, tmp_path, split):
    folder = tmp_path / "in"
    folder.mkdir()
    files = {"a.json": (_items(120), 2), "b.json": (_items(80, 2), None), "c.json": ([], None), "d.json": (_items(1, 3), 1)}
    for name, (items, indent) in files.items():
        (folder / name).write_text(json.dumps(items, indent=indent, ensure_ascii=name == "b.json") + "\n" * (name == "b.json"))
    got = _rows(read_array_items(spark, str(folder), SCHEMA, split_bytes=split))
    assert got == sum((_told(items) for items, _ in files.values()), Counter())
    assert got == _rows(read_items(spark, str(folder), SCHEMA))


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    (tmp_path / "big.json").write_text(json.dumps(_items(2000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    spark.conf.set("spark.sql.files.openCostInBytes", "8192")
    try:
        from shelfline.sources.arrays import _pieces

        pieces = _pieces(spark, str(tmp_path / "big.json"))
        assert pieces.rdd.getNumPartitions() > 8 and pieces.select("split").distinct().count() > 8
        assert _rows(read_array_items(spark, str(tmp_path / "big.json"), SCHEMA)) == _told(_items(2000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_damaged_files(spark, tmp_path):
    items = _items(40)
    text = json.dumps(items)
    for at in (len(text) // 2, len(text) - 1, text.index("}, {") + 1):
        path = tmp_path / f"cut{at}.json"
        path.write_text(text[:at])
        assert read_array_items(spark, str(path), SCHEMA, split_bytes=500).count() == 0
        kept = _rows(read_array_items(spark, str(path), SCHEMA, strict=False, split_bytes=500))
        whole = [i for k, i in enumerate(items) if len(json.dumps(items[: k + 1])) - 1 <= at]
        assert kept == _told(whole)
    for name, content in (("empty", ""), ("word", "nothing here"), ("object", '{"name": "x"}'), ("text", '"{}"')):
        (tmp_path / name).write_text(content)
        assert read_array_items(spark, str(tmp_path / name), SCHEMA).count() == 0
    assert read_array_items(spark, str(tmp_path / "missing"), SCHEMA).count() == 0


@pytest.fixture
def written(monkeypatch):
    """The intermediate tables of a read, by label."""
    tables = {}

    def keep(df, label):
        tables[label] = materialise(df, label)
        return tables[label]

    monkeypatch.setattr(arrays, "materialise", keep)
    return tables


def test_small_splits_share_tasks(spark, tmp_path, written, monkeypatch):
    files = {f"{k}.json": _items(150, k) for k in range(6)}
    for name, items in files.items():
        (tmp_path / name).write_text(json.dumps(items))
    tasks = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    split_sizes = []
    keep = arrays.materialise
    monkeypatch.setattr(arrays, "materialise", lambda df, label: split_sizes.append(spark.conf.get("spark.sql.files.maxPartitionBytes")) or keep(df, label))
    got = _rows(read_array_items(spark, str(tmp_path), SCHEMA, split_bytes=300))
    assert got == sum(map(_told, files.values()), Counter())
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    pieces = written["json-pieces"]
    assert pieces.select("file", "split").distinct().count() > 200
    assert len(pieces.inputFiles()) <= tasks
    # Only the files are read in small splits, not the tables written from them.
    assert split_sizes == ["300"] + [before] * (len(written) - 1)


def test_query_writes_one_folder_of_arrays(spark, tmp_path, written):
    ids = [*range(250), None, None, 7]
    html = lambda i: None if i == 3 else f'<li><a href="/{i}">{i}</a></li><li><a href="/\\{{{i}">x</a></li>' * (i != 4)
    spark.createDataFrame([(i, "u", html(i)) for i in ids], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = Counter((r["link"], r["price"]) for r in s4_split_item_arrays(spark, str(tmp_path)).collect())
    told = Counter((link, i if i is None else float(i)) for i in ids if i not in (3, 4) for link in (f"/{i}", f"/\\{{{i}"))
    assert got == told
    files = [r["file"] for r in written["json-pieces"].select("file").distinct().collect()]
    # Three hundreds, and the pages without an id.
    assert len(files) == 4 and len({f.rpartition("/")[0] for f in files}) == 1


def test_query_without_pages(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    assert s4_split_item_arrays(spark, str(tmp_path)).count() == 0
