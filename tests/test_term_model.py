"""The weight-table model: against Spark ML's solver, the fitted pipeline, and odd input."""
import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from titlepulse.operators import term_model as TW
from titlepulse.operators import text_model as TM

ROWS = [(i, " ".join(w for k, w in enumerate(["good", "fine", "bad", "poor", "maybe", "film"]) if (i * 7 + k * 3) % (k + 2) == 0) + f" word{i % 5}", i % 3)
        for i in range(90)]
SCHEMA = "doc_id long, text string, label int"


def test_ridge_equals_spark_ml(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    tok = TM.tokens(docs)
    # Without the constant: Spark ML gives features that never vary no weight.
    data = TW.vectors(tok, TW.class_terms(tok, 6), 6).withColumn("x", F.slice("x", 1, 6))
    w = TW.fit_ridge(data, 6, ridge=0.05)
    lr = LogisticRegression(featuresCol="v", labelCol="label", family="multinomial", regParam=0.05, standardization=False, fitIntercept=False, tol=1e-12, maxIter=500)
    model = lr.fit(data.select("label", array_to_vector("x").alias("v")))
    assert np.abs(model.coefficientMatrix.toArray() - w).max() < 1e-5
    # The gradient vanishes at the solution, and not next to it.
    _, grad, _, n = TW._sums(data, w, "label")
    assert np.abs(grad / n + 0.05 * w).max() < 1e-11
    assert np.abs(TW._sums(data, w + 0.01, "label")[1] / n + 0.05 * (w + 0.01)).max() > 1e-4


def test_features_by_hand(spark):
    rows = [(1, "x x y", 0), (2, "y", 1), (3, "", 1), (4, None, 2)]
    tok = TM.tokens(spark.createDataFrame(rows, SCHEMA))
    terms = TW.class_terms(tok, 2)
    assert [r["term"] for r in terms.orderBy("idx").collect()] == ["", "x"]  # in all of class 2, in all of class 0; then y
    got = {r["doc_id"]: r["x"] for r in TW.vectors(tok, terms, 2).collect()}
    assert got[1] == [0.0, 1.0, 1.0] and got[2] == [0.0, 0.0, 1.0] and got[3] == got[4] == [1.0, 0.0, 1.0]


@pytest.mark.parametrize("classes", [2, 3])
def test_pipeline_table_equals_pipeline(spark, classes):
    docs = spark.createDataFrame([(i, t, y % classes) for i, t, y in ROWS], SCHEMA)
    model = TM.fit(docs, vocab_size=50, max_iter=20)
    table = TW.pipeline_weights(model)
    new = docs.unionByName(spark.createDataFrame([(1000, "unknown words", 0), (1001, None, 0), (1002, "good good film", 0)], SCHEMA))
    mine = {r["doc_id"]: (r["prediction"], r["p"]) for r in TW.score_by_terms(table, new, classes=classes, unit=False).collect()}
    theirs = model.transform(new.fillna({"text": ""})).select("doc_id", "prediction", vector_to_array("probability").alias("p")).collect()
    assert len(mine) == len(theirs) == 93
    for r in theirs:
        assert np.allclose(mine[r["doc_id"]][1], r["p"], atol=1e-12) and mine[r["doc_id"]][0] == int(r["prediction"])


def test_stream_equals_batch(spark, tmp_path):
    from titlepulse.streaming.runner import await_done, start
    from titlepulse.streaming.sinks import parquet_batch_writer

    docs = spark.createDataFrame(ROWS, SCHEMA)
    weights = TW.train(docs, 4)
    docs.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    write = parquet_batch_writer(str(tmp_path / "out"))
    await_done(start(stream, lambda df, b: write(TW.score_by_terms(weights, df, keep=["doc_id"]), b), str(tmp_path / "ckpt")), 120)
    cols = ["doc_id", "prediction", "p"]
    key = lambda df: sorted((r["doc_id"], r["prediction"], tuple(round(x, 12) for x in r["p"])) for r in df.select(*cols).collect())
    assert key(spark.read.parquet(str(tmp_path / "out"))) == key(TW.score_by_terms(weights, docs))


def test_odd(spark):
    empty = spark.createDataFrame([], SCHEMA)
    weights = TW.train(empty, 3)
    scored = TW.score_by_terms(weights, spark.createDataFrame([(1, "a b", 0), (2, None, 1)], SCHEMA)).collect()
    assert all(np.allclose(r["p"], [1 / 3] * 3) and r["prediction"] == 0 for r in scored)
    assert TW.score_by_terms(weights, empty).collect() == []
    one = spark.createDataFrame([(i, "same text", 1) for i in range(5)] + [(9, "other", None), (10, "other", 7)], SCHEMA)
    got = TW.score_by_terms(TW.train(one, 3), one).filter("doc_id < 5")
    assert got.filter(F.col("prediction") != 1).isEmpty() and got.count() == 5
