"""The pipeline's stages on rows that are unlike the driver's."""

import hashlib
import os

import pytest

import corpus_pipeline as cp
from linkweave.llm import common, quality

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, key string, rep string, kept string, s_marks string, __words string, score string, hits string"


@pytest.fixture(scope="module")
def rows(spark):
    prose = [r[0] for r in common.table(spark, DATA, "documents").select("text").orderBy("doc_id").limit(12).collect()]
    item = common.table(spark, DATA, "benchmark").orderBy("item_id").first()["text"]
    texts = [None, "", "  \n\t", *prose, prose[1], prose[1] + " and one more", "first words of a page . " + item + " . last words of it", " ".join(f"word{i % 4001} of line {i}" for i in range(20_000))]
    listed = [(i, t, "en", "src01", 0 if t is None else len(t)) for i, t in enumerate(texts)]
    listed += [(3, prose[0], None, None, None), (None, prose[2], "en", None, 1), (None, None, None, None, None)]
    return [(*r, *(f"clash{k}" for k in range(7))) for r in listed], item


def test_stages(spark, rows):
    listed, item = rows
    docs = spark.createDataFrame(listed, COLUMNS)
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns
        told = [tuple(r) for r in out.collect()]
        assert all(r in listed for r in told)
        docs = common.materialize(out)
    told = {r[0] for r in docs.select("doc_id").collect()}
    assert 15 not in told  # a copy of row 4
    assert not [r for r in docs.collect() if r["text"] and item in r["text"]]
    last = cp.sentencepiece(spark, docs, DATA)
    assert last.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "decoded_sha256"]
    digests = sorted(hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in docs.collect())
    assert sorted(r["decoded_sha256"] for r in last.collect()) == digests


def test_each_stage_keeps_what_it_says(spark, rows):
    listed, item = rows
    docs = spark.createDataFrame(listed, COLUMNS)
    near = cp.near_dedup(spark, docs, DATA).collect()
    assert sorted(str(r["doc_id"]) for r in near if r["doc_id"] in (None, 0, 1, 2, 3)) == ["0", "1", "2", "3", "3", "None", "None"]
    clean = cp.benchmark_decontamination(spark, docs, DATA).collect()
    assert {r["doc_id"] for r in clean} >= {None, 0, 1, 2}
    assert 17 not in {r["doc_id"] for r in clean}
    want = {(r["doc_id"], r["text"]) for r in quality.score_quality(docs, common.table(spark, DATA, "labels")).where("predicted = 1").collect()}
    assert {(r["doc_id"], r["text"]) for r in cp.quality(spark, docs, DATA).collect()} == want


def test_no_rows(spark):
    docs = spark.createDataFrame([], COLUMNS)
    for _, stage in cp.STAGES:
        assert stage(spark, docs, DATA).collect() == []


def test_scores_keep_clashing_columns(spark, rows):
    docs = spark.createDataFrame(rows[0], COLUMNS)
    out = quality.score_quality(docs, common.table(spark, DATA, "labels"))
    assert out.columns == [*(c for c in docs.columns if c != "score"), "score", "held_out", "predicted"]
    assert {r["s_marks"] for r in out.collect()} == {"clash3"}


def test_shared_folder(spark, monkeypatch):
    path = common.shared_dir(spark)
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    common.remove_shared(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)

    class Elsewhere:
        master, applicationId = "spark://host:7077", "app"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = type("Conf", (), {"get": staticmethod(lambda k, d: d)})
        sparkContext = Elsewhere()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session())
