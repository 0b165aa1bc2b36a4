"""What goes to Python at once is bounded, in rows and in bytes, and the language machines keep few rows in float64."""

import tracemalloc

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest

from pagefolio.llm import batches, language_id, personal_data, quality_rules


@pytest.fixture
def settings(spark):
    before = {key: spark.conf.get(key) for key in batches.LIMITS}
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def sizes(docs):
    def run(parts):
        for part in parts:
            yield pa.record_batch([pa.array([part.num_rows])], ["n"])

    return [r.n for r in docs.mapInArrow(run, "n long").collect()]


def test_long_texts_make_small_batches(spark, settings):
    docs = spark.range(1200).selectExpr("id as doc_id", "repeat('x', 20000) as text").coalesce(1)
    assert max(sizes(docs)) > 1000
    with batches.small_batches(spark):
        found = sizes(docs)
    assert sum(found) == 1200 and max(found) * 20000 < 1.1 * batches.ARROW_BYTES
    assert max(sizes(docs)) > 1000


def test_smaller_limits_stay(spark, settings):
    keys = list(batches.LIMITS)
    spark.conf.set(keys[0], "7")
    spark.conf.set(keys[1], "1m")
    batches.bound_batches(spark)
    assert [spark.conf.get(k) for k in keys] == ["7", "1m"]
    spark.conf.set(keys[0], "0")
    spark.conf.set(keys[1], "64m")
    assert batches.bound_batches(spark) == {keys[0]: "0", keys[1]: "64m"}
    assert [spark.conf.get(k) for k in keys] == [str(x) for x in batches.LIMITS.values()]


def test_every_stage_bounds_its_batches(spark, settings, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    for module, name in (
        (quality_rules, "kept_documents"),
        (language_id, "train"),
        (language_id, "documents_in"),
        (corpus_pipeline.near_duplicates, "without_near_duplicates"),
        (personal_data, "train"),
        (personal_data, "without_personal_data"),
        (corpus_pipeline.packing, "packed_documents"),
    ):
        monkeypatch.setattr(module, name, lambda *_: docs)
    for _, stage in corpus_pipeline.STAGES:
        for key in batches.LIMITS:
            spark.conf.set(key, "1g" if "Bytes" in key else "10000")
        stage(spark, docs, "")
        assert {k: int(spark.conf.get(k)) for k in batches.LIMITS} == batches.LIMITS


def test_machines_do_not_copy_the_sample():
    rng = np.random.default_rng(5)
    x = rng.random((3000, 2000), np.float32)
    x[:1500, :50] += 0.3
    parts, y = [x[:1500], x[1500:]], np.r_[np.ones(1500), -np.ones(1500)]
    tracemalloc.start()
    w = language_id.fit_svm(parts, y)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < x.nbytes
    assert (np.sign(x @ w[:-1] + w[-1]) == y).mean() > 0.99


def test_machine_is_at_the_least_loss():
    """The gradient of the loss, over all rows at once, is nought; blocks and parts change nothing."""
    rng = np.random.default_rng(6)
    x = rng.random((1300, 40), np.float32)
    y = np.where(x[:, 0] + 0.3 * rng.random(1300) > 0.6, 1.0, -1.0)
    w = language_id.fit_svm([x[:700], x[700:701], x[701:]], y)
    full = np.hstack([x, np.ones((1300, 1))])
    weight = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum())
    slack = np.maximum(1 - y * (full @ w), 0)
    assert np.linalg.norm(1e-4 * w - full.T @ (weight * y * slack)) < 2e-6
    assert np.allclose(w, language_id.fit_svm([x], y), atol=1e-6)
