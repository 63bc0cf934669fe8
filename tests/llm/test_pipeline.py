"""The pipeline against its stages worked out plainly, and the order of its stages."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from shelfline.llm import licenses  # noqa: F401
from shelfline.llm.common import table
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents before and after every stage, each written and read again."""
    docs, out = table(spark, FOLDER, "documents"), []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(i))
        stage(spark, docs, FOLDER).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return out


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def texts(df):
    return [(r.doc_id, r.text, r.source) for r in df.select("doc_id", "text", "source").collect()]


def test_stages_return_documents(stages):
    assert len(stages) == 5
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes


def test_rejected_documents_go(stages, rows):
    _, before, after = stages[0]
    known = dict(rows("labels", "doc_id, quality"))
    kept = ids(after)
    wrong = [i for i, q in known.items() if (i in kept) != bool(q)]
    assert kept <= ids(before) and len(wrong) <= 0.03 * len(known)


def test_one_document_of_each_group_stays(stages):
    _, before, after = stages[1]
    groups = brute.component_rows([(i, brute.fingerprint(t)) for i, t, _ in texts(before)])
    assert ids(after) == Counter({g: 1 for *_, g in groups})


def test_contaminated_documents_go(stages, rows):
    _, before, after = stages[2]
    hits = brute.contamination_rows([(i, t) for i, t, _ in texts(before)], rows("benchmark", "item_id, text"))
    assert ids(after) == Counter(r[0] for r in hits if not r[5])


def test_sources_reach_their_targets(stages):
    _, before, after = stages[3]
    taken = brute.mixing_rows(texts(before))
    assert ids(after) == Counter({i: int(t / n + 0.5) for i, n, _, _, t in taken if n and int(t / n + 0.5)})


def test_shards_of_the_mixture(stages):
    _, before, after = stages[4]
    assert ids(after) == ids(before)
    sizes = Counter(r.shard for r in after.select("shard").collect())
    assert len(sizes) == 16 and max(sizes.values()) - min(sizes.values()) <= 1


def test_run_gives_what_the_stages_give(spark, stages):
    got = corpus_pipeline.run(spark, FOLDER)
    columns = ["doc_id", "text", "source", "shard", "slot"]
    assert Counter(map(tuple, got.select(columns).collect())) == Counter(map(tuple, stages[-1][2].select(columns).collect()))


@pytest.mark.parametrize("which", ["odd", "none"])
def test_stages_on_odd_rows(request, spark, which):
    """Null, empty and very long texts, repeated rows and ids, clashing names, an empty table."""
    docs = request.getfixturevalue(which).withColumnRenamed("text", "TEXT")
    for _, stage in corpus_pipeline.STAGES[:4]:
        after = stage(spark, docs, FOLDER)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        kept, before = (Counter(str(r) for r in df.collect()) for df in (after, docs))
        assert set(kept) <= set(before) and (which == "none") == (not before)
        if stage is not corpus_pipeline.mix_sources:
            assert all(n <= before[r] for r, n in kept.items())
    shards = corpus_pipeline.deal_shards(spark, docs, FOLDER)
    assert shards.count() == docs.count() and {"shard", "slot"} <= set(shards.columns)
    assert all(0 <= r.shard < corpus_pipeline.SHARDS for r in shards.collect())


def test_odd_documents_that_are_near_or_contaminated_go(spark, odd):
    groups = brute.component_rows([(i, brute.fingerprint(t)) for i, t, _ in texts(odd)])
    assert ids(corpus_pipeline.drop_near_duplicates(spark, odd, FOLDER)) == Counter({g: 1 for *_, g in groups})
    # No odd text holds a passage of the benchmark.
    assert ids(corpus_pipeline.drop_contaminated(spark, odd, FOLDER)) == ids(odd)
    # Texts without words are not in the mixture.
    assert not [t for _, t, _ in texts(corpus_pipeline.mix_sources(spark, odd, FOLDER)) if not brute.RUN.findall(t or "")]
