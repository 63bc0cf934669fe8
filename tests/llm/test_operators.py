"""Every operator against a plain version, on the test tables and on odd rows."""

from __future__ import annotations

import json
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfline.llm import decontaminate, licenses, mixing, pages, quality, secrets, shards, simhash, tokens, topk
from shelfline.llm.common import table, written
from tests.llm import brute
from tests.llm.conftest import FOLDER

BPE = public_tokenizers.path("byte_bpe_50k.json")


def collected(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def triples(df):
    return [(r.doc_id, r.text, r.source) for r in df.select("doc_id", "text", "source").collect()]


# 1: licences


LICENSE_COLUMNS = "doc_id n_words n_base first_word last_word base_labels labels score".split()


@pytest.mark.parametrize("which", ["documents", "odd"])
def test_licenses_equal_plain_search(request, which):
    docs = request.getfixturevalue(which)
    expected = brute.license_rows(pairs(docs), licenses.BASE, licenses.TEMPLATES, licenses.LEAST)
    assert collected(licenses.license_scan(docs), *LICENSE_COLUMNS) == Counter(expected)


def test_licenses_partial_grant(spark):
    grant = licenses.TEMPLATES[0][1]
    texts = ["x " + grant, grant.replace("charge", "cost"), grant.replace("granted", "given"), "permission is hereby granted to nobody"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r.doc_id: (r.labels, r.n_base) for r in licenses.license_scan(docs).collect()}
    assert found == {0: ("mit", 0), 1: ("mit", 0), 2: ("", 0), 3: ("", 0)}


def test_licenses_run_without_python(documents):
    plan = documents.sparkSession._jvm.PythonSQLUtils.explainString(licenses.license_scan(documents)._jdf.queryExecution(), "simple")
    assert not re.search("Python|Pandas|Arrow|Exchange hashpartitioning\\(doc_id", plan)


# 2: quality


def test_quality_on_the_held_out_fold(spark, rows):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    known = dict(rows("labels", "doc_id, quality", "/root/testdata/sf0.01"))
    got = quality.quality_scores(docs, labels).collect()
    assert all(r.held_out == (brute.crc(str(r.doc_id)) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    tested = [(r.predicted, known[r.doc_id]) for r in got if r.held_out and r.doc_id in known]
    assert len(tested) > 50 and sum(a == b for a, b in tested) >= 0.97 * len(tested)


def test_quality_ignores_held_out_labels(spark, documents):
    labels = table(spark, FOLDER, "labels")
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(doc_id AS string)) % 3 = 1 THEN 1 - quality ELSE quality END AS quality")
    a, b = (collected(quality.quality_scores(documents, x), "doc_id", "score") for x in (labels, flipped))
    assert a == b


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 0), (1, 1), (None, 1), (2, None), (4, 1), (5, 0), (9, 1), (10, 0), (99, 1)], "doc_id long, quality int")
    got = quality.quality_scores(odd, labels)
    assert got.count() == odd.count() and got.where("score IS NULL OR held_out IS NULL").count() == 0
    assert {r.score for r in quality.quality_scores(odd, labels.where("1 = 0")).collect()} == {0.5}
    assert quality.quality_scores(none, labels).count() == 0
    assert quality.accepted(odd, labels).columns == odd.columns


def test_statistics_equal_plain_counts(rows):
    texts = [t for (t,) in rows("documents", "text")] + [None, "", "\n\n", "a", "\U0001f600 \u00e9!\n|x|\u2028y", "A1 b2\tc3." * 5000]
    for text in texts:
        assert np.allclose(quality.statistics(text), brute.document_statistics(text), rtol=1e-12, atol=1e-12)
    assert len(quality.statistics(None)) == quality.N_STATISTICS and not any(quality.statistics(None))


def test_trees_walk_like_plain_recursion():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(int)
    model = quality.fit(x, y)
    assert ((model.scores(x) >= 0.5) == y).mean() > 0.97

    def walk(row):
        total = model.base
        for node in model.roots:
            while model.left[node] != node:
                node = model.left[node] if row[model.feature[node]] <= model.threshold[node] else model.right[node]
            total += model.value[node]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(model.scores(x[:50]), [walk(r) for r in x[:50]])
    assert quality.fit(x[:0], y[:0]).scores(x[:1])[0] == 0.5


# 3: decontamination


HIT_COLUMNS = "doc_id n_words n_hit n_items items_sha256 contaminated".split()


def test_contamination_equals_plain_search(spark, documents, rows):
    items = table(spark, FOLDER, "benchmark")
    expected = Counter(brute.contamination_rows(pairs(documents), rows("benchmark", "item_id, text")))
    assert sum(n for r, n in expected.items() if r[5]) > 0
    assert collected(decontaminate.contamination(documents, items), *HIT_COLUMNS) == expected
    # Blocks of any size give the same rows.
    assert collected(decontaminate.contamination(documents, items, block_bytes=1500), *HIT_COLUMNS) == expected


def test_each_automaton_is_built_once_a_task(spark, monkeypatch, tmp_path):
    words = [f"w{i}" for i in range(400)]
    items = spark.createDataFrame([(i, " ".join(words[20 * i : 20 * i + 20])) for i in range(20)], "item_id int, text string")
    texts = [(i, f"x {' '.join(words[20 * (i % 20) + 3 : 20 * (i % 20) + 15])} y {' '.join(words[5:17])}" if i % 3 else None) for i in range(90)]
    docs = spark.createDataFrame(texts, "doc_id int, text string").repartition(2, "doc_id")
    whole = items.selectExpr("sum(octet_length(text))").first()[0]
    _, blocks = decontaminate.item_blocks(items, whole // 3 + 1)
    builds = str(tmp_path)

    class Counted(decontaminate.Scanner):
        def __init__(self, *args):
            import tempfile

            tempfile.NamedTemporaryFile(dir=builds, delete=False).close()
            super().__init__(*args)

    monkeypatch.setattr(decontaminate, "Scanner", Counted)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        monkeypatch.setattr("shelfline.llm.common.BATCH_ROWS", 5)
        got = collected(decontaminate.contamination(docs, items, block_bytes=whole // 3 + 1), *HIT_COLUMNS)
        import os

        assert blocks == 3 and 0 < len(os.listdir(builds)) <= 3 * docs.rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    told = [(r.item_id, r.text) for r in items.collect()]
    assert got == Counter(brute.contamination_rows(texts, told)) == collected(decontaminate.contamination(docs, items), *HIT_COLUMNS)
    one, many = (decontaminate.contamination(docs, items, block_bytes=b).select("doc_id", "spans") for b in (1 << 20, 300))
    assert {r.doc_id: r.spans for r in one.collect()} == {r.doc_id: r.spans for r in many.collect()}
    kept = decontaminate.decontaminated(docs, items, block_bytes=300)
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in got if not r[5]}


def test_contamination_of_odd_rows(spark, odd, none):
    data = [(1, "One, two THREE"), (2, "one two three"), (2, "one two three"), (None, "a"), (3, None), (4, "..."), (5, "word " * 12)]
    items = spark.createDataFrame(data, "item_id long, text string")
    expected = Counter(brute.contamination_rows(pairs(odd), data))
    assert collected(decontaminate.contamination(odd, items), *HIT_COLUMNS) == expected
    assert decontaminate.contamination(none, items).count() == 0
    clean = decontaminate.decontaminated(odd, items)
    assert clean.columns == odd.columns and clean.count() == sum(n for r, n in expected.items() if not r[5])
    assert decontaminate.contamination(odd, items.where("1 = 0")).where("contaminated").count() == 0


def test_contamination_spans_are_places_of_the_original(spark):
    text = "é\U0001f600x  ONE--two\n\nthreeé one, Two; THREE. end"
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    items = spark.createDataFrame([(1, "one two three")], "item_id int, text string")
    (row,) = decontaminate.contamination(docs, items).collect()
    assert [text[s.start : s.end] for s in row.spans] == ["one, Two; THREE"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=14), max_size=4), st.lists(st.sampled_from("abc"), max_size=40))
def test_scanner_on_repetitive_words(items, words):
    listed = [(str(i), " ".join(w)) for i, w in enumerate(items)]
    scanner = decontaminate.Scanner(listed, 4)
    found, ids = scanner.scan(f" {' '.join(words)} ".encode())
    row = brute.contamination_rows([(0, " ".join(words))], listed, 4)[0]
    assert sum(b - a for a, b in decontaminate.merged(found)) == row[2] and len(ids) == row[3]


# 4: token counts


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


def test_token_counts_equal_the_library(documents, odd, none, library):
    for docs in (documents, odd):
        got = collected(tokens.token_counts(docs, BPE), "doc_id", "n_bytes", "n_tokens", "over_limit")
        expected = Counter()
        for i, t in pairs(docs):
            n = len(library.encode(t or "", add_special_tokens=False).ids)
            expected[i, len((t or "").encode()), n, n > 512] += 1
        assert got == expected
    assert tokens.token_counts(none, BPE).count() == 0


ODD_LETTERS = st.text(st.sampled_from("abcdeé ß  \n\t\r'sltvrem019٣½​　\x85\x1c\xa0中文\U0001f600<|>.,!?_-́ͅ"), max_size=25)


@settings(max_examples=300, deadline=None)
@given(ODD_LETTERS, st.sampled_from(["", "<|endoftext|>", "<|endoftext|> x", "'ll  "]))
def test_every_prefix_has_its_exact_count(text, tail):
    library, whole = Tokenizer.from_file(BPE), text + tail
    answers = tokens.counter(BPE).table(whole)
    exact = [len(library.encode(whole[:k], add_special_tokens=False).ids) for k in range(len(whole) + 1)]
    assert [answers.tokens(k) for k in range(len(whole) + 1)] == exact
    for budget in (0, 1, 3, 8):
        assert answers.truncated(budget) == max(k for k, n in enumerate(exact) if n <= budget)


def test_truncation_to_a_budget(odd, documents, library):
    for docs, budget in ((odd, 3), (odd, 40), (documents.limit(20), 64)):
        known = pairs(docs)
        for (_, text), r in zip(known, tokens.truncations(docs, BPE, budget).collect()):
            text = text or ""
            fits = [len(library.encode(text[:n], add_special_tokens=False).ids) <= budget for n in range(min(len(text), 400) + 1)]
            if r.kept_chars < 400:
                assert r.kept_chars == max(n for n, ok in enumerate(fits) if ok)
            assert r.kept_tokens == len(library.encode(text[: r.kept_chars], add_special_tokens=False).ids) <= budget
            assert r.n_tokens == len(library.encode(text, add_special_tokens=False).ids)


def test_truncation_inside_one_long_piece(library):
    for text in ("a" * 5000, "\u4e2d" * 700, " " * 900 + "x", "ab" * 300 + "!" * 300, "1234567890" * 50):
        table = tokens.counter(BPE).table(text)
        for budget in (0, 1, 5, 33, 200):
            kept = table.truncated(budget)
            exact = [len(library.encode(text[:n], add_special_tokens=False).ids) for n in range(max(0, kept - 40), min(len(text), kept + 40) + 1)]
            assert max(n for n, e in enumerate(exact) if e <= budget) + max(0, kept - 40) == kept


# 5: sharding


def test_shards_equal_plain_dealing(documents):
    got = {r.doc_id: (r.shard, r.slot) for r in shards.interleave(documents, 16).select("doc_id", "shard", "slot").collect()}
    assert got == brute.shard_rows(triples(documents))


def test_shards_hold_with_many_cells(documents, monkeypatch):
    monkeypatch.setattr("shelfline.llm.common.ROWS_PER_CELL", 7)
    monkeypatch.setattr("shelfline.llm.common.CELLS_TOGETHER", 3)
    got = {r.doc_id: (r.shard, r.slot) for r in shards.interleave(documents, 5).select("doc_id", "shard", "slot").collect()}
    assert got == brute.shard_rows(triples(documents), 5)


@pytest.mark.parametrize("lead", [(), ("v",)])
def test_running_sums_past_hot_keys(spark, monkeypatch, lead):
    from shelfline.llm import common

    monkeypatch.setattr(common, "ROWS_PER_CELL", 20)
    rng = random.Random(4)
    ids = [rng.choice(["hot", "warm", *map(str, range(400))]) if rng.random() < 0.5 else "hot" for _ in range(900)]
    data = [(rng.choice("aab"), i, rng.choice([0, 5, 7]), k) for k, i in enumerate(ids)]
    rows = spark.createDataFrame(data, "g string, id string, v long, k int").select(
        "*", common.order_key(1, F.col("id")).alias("key"), F.xxhash64("k").alias("tie")
    )
    seen = {}
    keep = common.written
    monkeypatch.setattr(common, "written", lambda df, label: seen.setdefault(label, keep(df, label)))
    got = common.before_in_group(rows, ["g"], "key", [*lead, "tie"], {"v": "sum"}, lead=lead)
    assert got.count() == 900 and sorted(got.columns) == sorted([*rows.columns, "sum_before", "sum_total"])
    by = {}
    for r in sorted(rows.collect(), key=lambda r: (r.g, r.key, *[r[c] for c in lead], r.tie)):
        by.setdefault(r.g, []).append(r)
    expected = {}
    for members in by.values():
        total = sum(r.v for r in members)
        for n, r in enumerate(members):
            expected[r.k] = (sum(x.v for x in members[:n]), total)
    assert {r.k: (r.sum_before, r.sum_total) for r in got.collect()} == expected
    # No cell of a hot key holds more than its share.
    cells = seen["hot-cells"].groupBy("g", "key", *lead, "sub").count()
    assert seen["hot-rows"].count() > 400 and cells.agg(F.max("count")).first()[0] < 3 * 20


def test_a_third_of_rows_without_id_and_sources_of_one_row(spark, monkeypatch):
    monkeypatch.setattr("shelfline.llm.common.ROWS_PER_CELL", 25)
    data = [(None if i % 3 == 0 else i, f"text {i}", f"one{i}" if i % 3 == 1 else "big") for i in range(600)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = shards.interleave(docs, 7).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((i, t) for i, t, _ in data)
    sizes = Counter(r.shard for r in got)
    assert len(sizes) == 7 and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in sizes.items())
    mixed = mixing.mix(docs).collect()
    assert sum(r.taken for r in mixed) == sum(r["size"] for r in mixed) * 3 // 2 and all(r.taken <= 2 * r["size"] for r in mixed)


def test_every_shard_has_the_mixture(documents):
    got = shards.interleave(documents, 4).groupBy("source", "shard").count().collect()
    whole = Counter(r.source for r in documents.collect())
    assert all(abs(r["count"] - whole[r.source] / 4) <= 1 for r in got)


def test_shards_of_odd_rows(odd, none):
    got = shards.interleave(odd, 4)
    assert got.columns == [c for c in odd.columns if c != "shard"] + ["shard", "slot"]
    sizes = Counter(r.shard for r in got.collect())
    assert sum(sizes.values()) == odd.count() and max(sizes.values()) - min(sizes.values()) <= 1
    for shard in sizes:
        assert sorted(r.slot for r in got.where(got.shard == shard).collect()) == list(range(sizes[shard]))
    assert shards.interleave(none, 4).count() == 0
    sized = {r.doc_id: (r["size"], r.text_crc32) for r in shards.sized(odd).collect()}
    assert all(sized[i] == (len((t or "").encode()) + 1, brute.crc(t)) for i, t in pairs(odd))


# 6: exact search


def test_top_k_equals_plain_search(spark, rows):
    got = collected(topk.top_k(table(spark, FOLDER, "embeddings"), per_shard=90, per_block=4), "query_id", "rank", "vec_id", "score")
    assert got == Counter(brute.top_rows(rows("embeddings", "vec_id, embedding")))


def test_top_k_with_ties_and_unsound_vectors(spark):
    rng = random.Random(6)
    data = [(i, [rng.choice([0.0, 0.5, -0.25]) for _ in range(3)]) for i in range(400)]
    data += [(1000, None), (1050, [1.0, None, 1.0]), (1100, [float("nan"), 1.0, 1.0]), (1150, [float("inf"), 0.0, 0.0]), (None, [9.0, 9.0, 9.0]), (1200, []), (1250, [1.0, 2.0])]
    rows = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("score", table(spark, FOLDER, "region").select("r_regionkey").limit(1).scalar())
    for size in (50, 10_000):
        got = collected(topk.top_k(rows, per_shard=size, per_block=3), "query_id", "rank", "vec_id", "score")
        assert got == Counter(brute.top_rows(data))
    assert topk.top_k(rows.where("vec_id < 0")).count() == 0
    assert topk.top_k(rows.where("vec_id < 3")).count() == 2


def registered_top_k(data):
    """What the query's SQL gives for rows of ``vec_id, embedding``."""
    import duckdb

    from shelfline.llm.sql import TOP_K

    base = duckdb.connect()
    base.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    base.executemany("INSERT INTO embeddings VALUES (?, ?)", [list(x) for x in data])
    return Counter(base.execute(TOP_K).fetchall())


@pytest.mark.parametrize("size", [7, 10_000])
def test_every_row_of_a_repeated_id_is_a_candidate(spark, tmp_path, size, monkeypatch):
    from shelfline.llm.queries import QUERIES

    rng = random.Random(7)
    # Ids repeat, those of queries too; a third of all rows has one id, and some rows are equal.
    data = [(rng.choice([0, 50, 77, 77, *range(30)]), [rng.choice([0.0, 0.5, -0.25, 1.0]) for _ in range(3)]) for _ in range(300)]
    data += [(77, [1.0, 1.0, 1.0])] * 100
    spark.createDataFrame(data, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    monkeypatch.setattr(topk.top_k, "__defaults__", (topk.K, 50, size, 3))
    got = collected(QUERIES["op6_exact_top_k"](spark, str(tmp_path)), "query_id", "rank", "vec_id", "score")
    assert got == registered_top_k(data) == Counter(brute.top_rows(data))


def test_the_other_row_of_a_query_id_is_its_candidate(spark):
    data = [(50, [1.0, 0.0]), (50, [0.5, 0.5]), (1, [0.1, 0.1])]
    got = collected(topk.top_k(spark.createDataFrame(data, "vec_id long, embedding array<float>")), "query_id", "rank", "vec_id", "score")
    assert got == Counter(brute.top_rows(data)) and got[50, 1, 50, 32_768] == 2


def test_components_that_outgrow_doubles_do_not_end_the_query(spark):
    data = [(0, [0.0, 2.0]), (50, [1.0, 1.0]), (1, [1e307, 3.0]), (2, [-1.7e308, 4.0]), (3, [0.25, 5.0]), (100, [0.0, 1e306]), (4, [9.0, 0.0]), (5, [-3.0, 0.0])]
    rows = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    for size in (2, 100):
        with pytest.raises(Exception, match="does not fit a long"):
            topk.top_k(rows, per_shard=size, per_block=1).collect()
        # Where no score among the best is that long, the vectors take part like any others.
        some = [x for x in data if x[0] not in (50, 100)]
        got = collected(topk.top_k(rows.where("vec_id NOT IN (50, 100)"), per_shard=size, per_block=1), "query_id", "rank", "vec_id", "score")
        assert got == Counter(brute.top_rows(some)) and got[0, 2, 2, 4 * 2 * 256 * 256] == 1


@pytest.mark.parametrize("size", [7, 10_000])
def test_large_components_count_and_are_exact(spark, size):
    rng = random.Random(8)
    # Doubles would round these scores: two vectors differ by one in products of 2 ** 60.
    data = [(i, [float(rng.randint(-9, 9)) for _ in range(3)]) for i in range(100)]
    data += [(100, [32768.0, 1.0, 0.0]), (150, [2.0**22, 1 / 256, 0.0]), (201, [2.0**22, 1 / 256, 1.0]), (202, [2.0**22, 0.0, 1.0])]
    data += [(203, [2.0**22, 2 / 256, -3.0]), (204, [-40_000.0, 0.0, 5.0]), (205, [2.0**22, 2 / 256, 7.0]), (206, [2.0**22, 3 / 256, 0.0])]
    rows = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    got = collected(topk.top_k(rows, per_shard=size, per_block=2), "query_id", "rank", "vec_id", "score")
    assert got == Counter(brute.top_rows(data)) == registered_top_k(data)
    far = [(1, [1e30, 1.0]), (2, [-1e30, 2.0]), (50, [0.0, 3.0]), (51, [3e38, 4.0])]
    got = collected(topk.top_k(spark.createDataFrame(far, "vec_id long, embedding array<float>")), "query_id", "rank", "vec_id", "score")
    assert got == Counter(brute.top_rows(far))
    with pytest.raises(Exception, match="does not fit a long"):
        topk.top_k(spark.createDataFrame([(0, [1e30]), (1, [1e30])], "vec_id long, embedding array<float>")).collect()
    with pytest.raises(Exception, match="does not fit a long"):
        topk.top_k(spark.createDataFrame([(0, [1e30]), (1, [-1e30])], "vec_id long, embedding array<float>")).collect()


def test_ball_tree_leaves_nodes_out():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 8)) * 100
    data = np.concatenate([c + rng.normal(size=(100, 8)) for c in centres]).round().astype(int)
    tree = topk.BallTree(np.arange(len(data)), data, 20)
    visited = []
    tree.rows = _Watched(tree.rows, visited)
    hits, _ = tree.search(data[:1], np.array([0]), np.array([-np.inf]), 5)
    scores = data @ data[0]
    best = sorted((-s, i) for i, s in enumerate(scores) if i)[:5]
    assert sorted((-s, i) for _, i, s in hits) == best and sum(visited) < len(data) / 4


class _Watched:
    def __init__(self, rows, visited):
        self.rows, self.visited = rows, visited

    def __getitem__(self, at):
        self.visited.append(at.stop - at.start)
        return self.rows[at]


# 7: pages


def page(body, head="<title>t</title>"):
    return f"<!DOCTYPE html><html><head>{head}<style>p{{}}</style></head><body>{body}</body></html>"


def test_article_and_nothing_else():
    html = page(
        "<nav><ul><li>menu</ul></nav><header>Site</header><div class='cookie-notice'>We use</div><div class=ad>buy</div>"
        "<article><h1>T &amp; U</h1><p><b>one\n  two<br><p>three&nbsp;four<p class=ad>buy</p><ul><li>a<li>b</ul>"
        "<script>if (a < b) { x(); }</script><form>name</form></article><aside>more</aside>"
        "<section id=comments><article>nice</article></section><footer>&copy; me</footer>"
    )
    lines = pages.page_lines(html)
    assert [x for x, p in lines if p == pages.ARTICLE] == ["T & U", "one two", "three four", "a", "b"]
    assert all(p == pages.BESIDE for x, p in lines if p != pages.ARTICLE)


@pytest.mark.parametrize(
    ("body", "kept"),
    [
        ("<div class='no-sidebar wrap'><p>text</p></div><div class=siteFooter>f</div><div id=cookieBar>c</div>", ["text"]),
        ("<article class='post with-comments'><div class=entry-header><h1>T</h1></div>x<div class=share-links>s</div></article>", ["T", "x"]),
        ("<div class=sidebar><p>s</p></div><p>a<p>b", ["a", "b"]),
        ("<main><p>a</main><div>b</div>", ["a"]),
        ("<![CDATA[x]]><p>1 < 2 &lt;b&gt; <3<p>&#x41;&unknown;</p><!-- <p>no</p> --><p hidden", ["1 < 2 <b> <3", "A&unknown;"]),
        ("<div><span class=ad>buy</span>text <em>and</em> more</div>", ["text and more"]),
    ],
)
def test_structure(body, kept):
    assert pages.candidates(pages.page_lines(page(body)))[0] == kept


def test_shared_lines_go_where_structure_is_silent(spark, monkeypatch):
    frame = "<div>Home of all</div><div>{}</div><div>{}</div><div>Imprint and rights</div>"
    data = [
        (1, "http://h.example/a/1", page(frame.format("First text", "Its end"))),
        (2, "http://h.example/a/2", page(frame.format("Second text", "Other end"))),
        (3, "http://h.example/b/9", page(frame.format("Third", "Last end"))),
        (4, "http://other.example/", page(frame.format("Alone", "here"))),
        (5, None, None), (6, "http://h.example/a/1", page(frame.format("First text", "Its end"))), (7, "no url", ""),
    ]
    for cell in (20_000, 3):
        docs = spark.createDataFrame(data, "page_id int, url string, html string")
        got = {r.page_id: (r.text, r.n_chars) for r in pages.main_texts(docs, cell).collect()}
        assert got[2] == ("Second text\nOther end", 21)
        assert got[5] == got[7] == ("", 0)
        assert got[4][0] == "Home of all\nAlone\nhere\nImprint and rights"
        assert got[1][0] == got[6][0] == "First text\nIts end"
        if cell > 3:
            assert got[3][0] == "Third\nLast end"


@pytest.mark.parametrize("cell", [1, 2, 3, 7, 20_000])
def test_large_hosts_are_paired_like_small_ones(spark, cell):
    """Every page has a folder of its own, and shares its section's line with the nearest URL only."""
    data, expected = [], {}
    for i in range(40):
        host, section = ("h.example", i // 2) if i < 36 else (f"h{i // 2}.example", i // 2)
        body = f"<div>Home</div><div>Section {section}</div><div>Text {i}</div><div>Imprint</div>"
        data.append((i, f"http://{host}/2024/{section:02d}/slug-{i}/", page(body)))
        expected[i] = f"Text {i}"
    docs = spark.createDataFrame(data, "page_id int, url string, html string").repartition(5)
    assert {r.page_id: r.text for r in pages.main_texts(docs, cell).collect()} == expected


@pytest.mark.parametrize("cell", [2, 20_000])
def test_lines_that_every_article_of_a_host_repeats(spark, cell):
    data, expected = [], {}
    for i in range(12):
        body = f"<article><h1>Title {i}</h1><p>Read our letter</p><p>Text {i}</p><p>{'Passage' if i in (4, 5) else f'More {i}'}</p></article>"
        data.append((i, f"http://h.example/{i:02d}", page(body)))
        expected[i] = f"Title {i}\nText {i}\n" + ("Passage" if i in (4, 5) else f"More {i}")
    for i in range(20, 24):  # copies of an article, all but a line
        data.append((i, f"http://copies.example/{i}", page(f"<article><h1>Same</h1><p>One</p><p>Two</p><p>Seen {i}</p></article>")))
        expected[i] = f"Same\nOne\nTwo\nSeen {i}"
    for i in range(30, 32):  # one page beside tells too little
        data.append((i, f"http://two.example/{i}", page(f"<article><h1>Title {i}</h1><p>Passage</p><p>Text {i}</p></article>")))
        expected[i] = f"Title {i}\nPassage\nText {i}"
    docs = spark.createDataFrame(data, "page_id int, url string, html string")
    assert {r.page_id: r.text for r in pages.main_texts(docs, cell).collect()} == expected


def test_a_teaser_does_not_stand_for_the_page(spark):
    frame = "<div>Home of all</div><div>{}</div><article><p>Teaser {}</p><p>Buy now</p></article><div>Long text of the page {}</div><div>Imprint</div>"
    data = [(i, f"http://h.example/{i}", page(frame.format(f"Title {i}", i, i))) for i in range(5)]
    docs = spark.createDataFrame(data, "page_id int, url string, html string")
    got = {r.page_id: r.text for r in pages.main_texts(docs).collect()}
    assert got == {i: f"Title {i}\nTeaser {i}\nLong text of the page {i}" for i in range(5)}


def test_pages_of_the_table(spark, rows):
    """Pages carry the article between its tags; only references and white space change."""
    import html as library

    got = {r.page_id: r.text for r in pages.main_texts(table(spark, FOLDER, "pages")).collect()}
    for page_id, raw in rows("pages", "page_id, html"):
        body = re.search("<article>(.*)</article>", raw, re.S)[1]
        blocks = [" ".join(library.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", body.replace("<br>", " "))]
        assert got[page_id] == "\n".join(b for b in blocks if b)


def test_pages_table_without_rows(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string, text string, lines int")
    assert pages.main_texts(empty).count() == 0


SMALL = st.lists(st.integers(0, 4), max_size=14)


@settings(max_examples=300, deadline=None)
@given(SMALL, SMALL, st.sampled_from([1 << 31, 6]))
def test_common_lines_are_longest(a, b, most):
    for found in (pages._inner_lines(a, b, most), pages.common_lines(a, b)):
        assert len(found) == brute.subsequence_length(a, b) and found == sorted(set(found))
        rest = iter(b)
        assert all(a[i] in rest for i in found)


def test_depth_costs_nothing_more():
    import time

    for html in ("<div>" * 100_000 + "</p>" * 100_000, "<font>" * 100_000 + "<p>x" * 20_000, "<b>" + "<div>" + "<font>" * 100_000 + "</b>" * 100_000):
        began = time.process_time()
        pages.page_lines(html)
        assert time.process_time() - began < 20


def test_class_words_do_not_cost_an_article_its_text():
    html = '<article><p class="notice-period">Three months.</p><div class="search-help">Try again.</div><div class="comment-list">Me too</div><div class=ad>Buy</div><p>End.</p></article>'
    assert [x for x, p in pages.page_lines(html) if p == pages.ARTICLE] == ["Three months.", "Try again.", "End."]
    # Beside an article, too, unmarked lines stay unless other pages have them.
    kept, places, _ = pages.candidates(pages.page_lines("<div>Short note.</div>" + html))
    assert kept[0] == "Short note." and places[0] == 0


# 8: mixing


MIX_COLUMNS = "doc_id size source_size target taken".split()


def same_mix(got, expected):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[4])
    got, expected = sorted((tuple(r) for r in got), key=key), sorted(expected, key=key)
    return len(got) == len(expected) and all(
        a[:3] == b[:3] and a[4] == b[4] and abs(a[3] - b[3]) < 1e-6 * max(1, b[3]) for a, b in zip(got, expected)
    )


def test_mix_equals_plain_mixing(documents, monkeypatch):
    expected = brute.mixing_rows(triples(documents))
    assert same_mix(mixing.mix(documents).select(*MIX_COLUMNS).collect(), expected)
    monkeypatch.setattr("shelfline.llm.common.ROWS_PER_CELL", 9)
    assert same_mix(mixing.mix(documents).select(*MIX_COLUMNS).collect(), expected)


def test_mix_of_odd_rows(odd, none):
    got = mixing.mix(odd)
    assert same_mix(got.where("doc_id <> 3 OR doc_id IS NULL").collect(), [r for r in brute.mixing_rows(triples(odd)) if r[0] != 3])
    assert got.where("taken > 2 * size").count() == 0 and got.count() == odd.count()
    assert mixing.mix(none).count() == 0 and mixing.mixed(none).count() == 0
    mixture = mixing.mixed(odd)
    assert mixture.columns == odd.columns
    times = {r.doc_id: round(r.taken / r["size"] + 1e-9) for r in got.where("size > 0 AND doc_id <> 3").collect()}
    assert Counter(r.doc_id for r in mixture.where("doc_id <> 3").collect()) == Counter({i: n for i, n in times.items() if n})


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.sampled_from([None, "a", "b", "c", "é", "", "z"]), st.integers(0, 50), min_size=1))
def test_targets_fill_the_whole_share(sizes):
    got = brute.targets(sizes)
    assert abs(sum(got.values()) - 1.5 * sum(sizes.values())) < 1e-6
    assert all(t <= 2 * sizes[s] + 1e-9 for s, t in got.items())


def test_targets_equal_the_repeated_sharing(spark):
    rng = random.Random(8)
    for _ in range(5):
        sizes = {s: rng.choice([0, 1, 5, 1000]) * rng.randint(0, 9) for s in [None, *map(str, range(9))]}
        rows = [(s is None, s or "", n) for s, n in sizes.items()]
        got = mixing.source_targets(spark.createDataFrame(rows, "no_src boolean, src string, size_total long"), mixing.WEIGHTS, 1.5, 2)
        found = {None if r.no_src else r.src: r.target for r in got.collect()}
        assert found == pytest.approx(brute.targets(sizes))


# 9: secrets


def test_secrets_equal_plain_search(documents, odd, none):
    for docs in (documents, odd):
        found = collected(secrets.secret_scan(docs).drop("spans"), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
        expected = Counter()
        for i, t in pairs(docs):
            spans = brute.base_secrets(t)
            digest = brute.sha256(",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()
            expected[i, *[sum(k == x for _, k, _ in spans) for x in range(3)], digest] += 1
        assert found == expected
    assert secrets.secret_scan(none).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.text("0123456789abcdefXYZ", min_size=1, max_size=60), st.sampled_from([2.5, 3.0, 3.4]))
def test_running_entropy_equals_that_of_each_window(text, bits):
    starts = [i for i in range(len(text) - 19) if brute.entropy(text[i : i + 20]) > bits + 1e-9 and brute.mixed(text[i : i + 20])]
    assert secrets.hot_windows(text, bits) == starts


def test_entropy_spans_and_allow_list():
    key = "Zx8Kq2Lm9Pw4Rt7Vb1Nc"
    assert secrets.entropy_spans(f"k {key} k") == [(2, 3, 22)]
    for fine in ("123e4567-e89b-12d3-a456-426614174000", "sha256-" + key, "2024-01-01-2024-01-02-33", "a" * 30 + "1", "internationalization2", "some/long-path/with-words/2024/a1b2c3d4e5f6"):
        assert secrets.entropy_spans(f" {fine} ") == []
    # An allowed word holds back the windows that overlap it, not the key beside it.
    assert secrets.entropy_spans(f" example{key} ") == [(8, 3, 28)]
    long = "key-yourK9f3A7c21E80b4D56aA17f3C2904e6B8dQzXw"
    assert secrets.entropy_spans(long)[0][2] == len(long) and secrets.entropy_spans(long)[0][0] >= 8
    # Letters of both cases, and upper-case hexadecimal beside other characters.
    assert secrets.entropy_spans("kJhGfDsAqWeRtYuIoPzXcVbNmLkJhGfDsA")
    (a, _, b), = secrets.entropy_spans("SIGNING_KEY=9F3A7C21E80B4D56AA17F3C2904E6B8D")
    assert a <= 12 and b == 44


@pytest.mark.parametrize("which", ["documents", "odd"])
def test_all_spans_equal_plain_windows(request, which):
    docs = request.getfixturevalue(which)
    keys = ["AWS=wJalrXUtnFEMI/K7MDENG/bPxRfiCYzzKEY1 and your_K9f3A7c21E80b4D56aA17f3C2", "x" * 500 + "9F3A7C21E80B4D56AA17" * 3]
    for text in [*keys, *(t for _, t in pairs(docs))]:
        assert {p for a, _, b in secrets.entropy_spans(text or "") for p in range(a, b)} == brute.hot_places(text or "")
    found = {r.doc_id: r.spans for r in secrets.secret_scan(docs).where("doc_id IS NOT NULL").select("doc_id", "spans").collect()}
    for i, t in pairs(docs):
        if i is not None and i != 3:
            every = sorted(brute.base_secrets(t) + secrets.entropy_spans(t or ""))
            assert found[i] == ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in every)


# 10: near-duplicates


DEDUP_COLUMNS = "doc_id fingerprint component_id".split()


@pytest.mark.parametrize("shard_rows", [simhash.SHARD_ROWS, 16])
def test_near_duplicates_equal_plain_search(documents, shard_rows):
    expected = brute.component_rows([(i, brute.fingerprint(t)) for i, t in pairs(documents)])
    assert collected(simhash.near_duplicates(documents, shard_rows=shard_rows), *DEDUP_COLUMNS) == Counter(expected)


def test_near_duplicates_of_odd_rows(odd, none):
    expected = brute.component_rows([(i, brute.fingerprint(t)) for i, t in pairs(odd)])
    assert collected(simhash.near_duplicates(odd), *DEDUP_COLUMNS) == Counter(expected)
    kept = simhash.without_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter({g: 1 for *_, g in expected})
    assert simhash.near_duplicates(none).count() == 0 and simhash.without_near_duplicates(none).count() == 0


def clustered(seed, n=600):
    rng = random.Random(seed)
    out = []
    for _ in range(12):
        at = rng.getrandbits(64)
        for _ in range(n // 12):
            for _ in range(rng.randint(0, 2)):
                at ^= 1 << rng.randrange(64)
            out.append(at)
    return np.unique(np.array(out, np.uint64))


@pytest.mark.parametrize("seed", range(4))
def test_trees_find_every_set_of_close_points(seed):
    points = clustered(seed)
    roots = simhash.join_close(points, len(points), 3, leaf=8)
    expected = brute.component_rows([(i, int(f)) for i, f in enumerate(points)])
    assert [int(r) for r in roots] == [r[2] for r in expected]
    layout = simhash.Layout(points[::3], len(points) / 48)
    at, shard, home = layout.route(points, 3)
    assert Counter(at[home].tolist()) == Counter(range(len(points)))
    homes = {int(a): int(s) for a, s, h in zip(at, shard, home) if h}
    visits = set(zip(at.tolist(), shard.tolist()))
    for i in range(len(points)):
        for j in np.nonzero(np.bitwise_count(points ^ points[i]) <= 3)[0]:
            assert (i, homes[int(j)]) in visits


@pytest.mark.parametrize("n", [65_536, 262_144, 1_048_576])
def test_cells_are_bounded_at_any_size(spark, n):
    points = spark.range(n).select(F.xxhash64("id").alias("fp"))
    placed = simhash.cells(points, simhash._layout(points, simhash.SHARD_ROWS), simhash.DISTANCE, simhash.SHARD_ROWS)
    sizes = placed.groupBy("shard", "i", "j").agg(F.count("*").alias("n"), F.count_if("held").alias("held"), F.count_if("seeks").alias("sought"))
    most = sizes.agg(F.max("n"), F.max("held"), F.max("sought")).first()
    assert most[0] <= 2 * simhash.SHARD_ROWS and most[1] <= 1.02 * simhash.SHARD_ROWS and most[2] <= 1.02 * simhash.SHARD_ROWS


def test_links_across_the_parts_of_full_shards(spark):
    # A layout of one shard, whose homes and seekers fall into many cells.
    points = clustered(9)
    rows = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    placed = simhash.cells(rows, simhash.Layout(points[:1], 1), 3, 40)
    assert placed.select("shard").distinct().count() == 1 and placed.groupBy("i", "j").count().count() == math.ceil(len(points) / 36) ** 2
    met = {(r.i, r.j): (set(), set()) for r in placed.select("i", "j").distinct().collect()}
    for r in placed.collect():
        for kind, there in zip((r.held, r.seeks), met[r.i, r.j]):
            if kind:
                there.add(r.fp)
    assert sum(len(held) * len(sought) for held, sought in met.values()) == len(points) ** 2
    roots = {r.node: r.root for r in simhash.components(simhash.close_links(rows, 3, 40)).collect()}
    expected = {i: g for i, _, g in brute.component_rows([(int(p), int(q)) for p, q in zip(points.view(np.int64), points)])}
    assert {i: roots.get(i, i) for i in expected} == expected


def test_components_of_a_long_chain(spark):
    order = list(range(3000))
    random.Random(3).shuffle(order)
    links = spark.createDataFrame(list(zip(order, order[1:])) + [(9001, 9000), (9000, 9001), (9002, 9002)], "a long, b long")
    roots = {r.node: r.root for r in simhash.components(links).collect()}
    assert {roots.get(i, 0) for i in range(3000)} == {0} and roots[9001] == 9000 and 9002 not in roots


def test_intermediate_tables_lie_in_the_shared_folder(spark, documents):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert all(shared in f for f in written(documents.select("doc_id"), "probe").inputFiles())
    assert json.dumps(shared)
