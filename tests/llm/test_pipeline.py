"""The pipeline: every stage against its operator's brute force on a small table."""

import pytest

import __spark_entry__ as catalog
import corpus_pipeline
from corpuskit.llm import simhash

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], SMALL).write.parquet(str(folder / name))
        out.append(spark.read.parquet(str(folder / name)))
    return out


def test_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_copies", "packing"]
    assert all(s.columns == stages[0].columns for s in stages[:4])


def test_filters_keep_sound_documents(spark, stages):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    for before, after in zip(stages[:2], stages[1:3]):
        assert after.join(before, "doc_id", "left_anti").count() == 0
        sound = before.join(labels.where("quality = 1"), "doc_id", "left_semi")
        assert sound.join(after, "doc_id", "left_semi").count() >= 0.98 * sound.count()
    poor = labels.where("quality = 0")
    assert stages[1].join(poor, "doc_id", "left_semi").count() <= 0.1 * poor.count()


def test_one_of_each_group_stays(stages):
    rows = [(r.doc_id, simhash.fingerprint(r.text) % 2**64) for r in stages[2].select("doc_id", "text").collect()]
    rows.sort()
    root = {d: d for d, _ in rows}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for n, (a, x) in enumerate(rows):
        for b, y in rows[n + 1 :]:
            if (x ^ y).bit_count() <= 4:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    assert sorted(r.doc_id for r in stages[3].select("doc_id").collect()) == sorted({find(d) for d, _ in rows})


def test_everything_that_stays_is_packed(stages):
    packed = stages[4].groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert all(r["sum(length)"] == r["max(doc_tokens)"] for r in packed)
    assert {r.doc_id for r in packed} == {r.doc_id for r in stages[3].select("doc_id").collect()}


def test_registered(spark):
    names = [f"op{n}_" for n in range(1, 14)]
    assert all(sum(q.startswith(n) for q in catalog.queries()) == 1 for n in names)
    assert "pipeline" in catalog.queries() and corpus_pipeline.ORACLE_SQL is None


def test_empty_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0


def test_every_model_sees_a_row_once(spark, monkeypatch):
    """Rows that pass the models in one run, counted in the tasks; the last stage reads what was settled."""
    seen = {}
    for name, module, function in (("quality", corpus_pipeline.quality, "graded"), ("language", corpus_pipeline.language, "predicted")):
        rows = seen[name] = spark.sparkContext.accumulator(0)

        def counted(docs, *args, plain=getattr(module, function), rows=rows, **named):
            def through(batches):
                for batch in batches:
                    rows.add(batch.num_rows)
                    yield batch

            return plain(docs.mapInArrow(through, docs.schema), *args, **named)

        monkeypatch.setattr(module, function, counted)
    small = "/root/testdata/sf0.001"
    packed = corpus_pipeline.run(spark, small)
    assert packed.count() > 0
    total = spark.read.parquet(f"{small}/documents.parquet").count()
    assert seen["quality"].value == total and 0 < seen["language"].value <= total
