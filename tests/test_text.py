import math

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from titlepulse.functions.text import ENGLISH_STOP_WORDS
from titlepulse.operators import text_model as TM
from titlepulse.plans.text_queries import labeled_documents


def test_stop_words_are_sparks_list(spark):
    assert ENGLISH_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")
    assert len(ENGLISH_STOP_WORDS) == 181


def test_tokens(spark):
    df = spark.createDataFrame([(1, " A  b\tC. "), (2, None)], "doc_id int, text string")
    got = {r.doc_id: (r.words, r.filtered) for r in TM.tokens(df).collect()}
    assert got[1][0] == ["", "a", "", "b", "c."]
    assert got[2][0] == [""]


def test_key_split_repeats(spark, sf):
    a = TM.key_split(labeled_documents(spark, sf), "doc_id")
    b = TM.key_split(labeled_documents(spark, sf).repartition(7), "doc_id")
    key = lambda df: sorted((r.doc_id, r.split) for r in df.collect())
    assert key(a) == key(b)
    share = a.filter(F.col("split") == "train").count() / a.count()
    assert 0.6 < share < 0.95


def test_model_fit_score_save_load(spark, sf, tmp_path):
    data = TM.key_split(labeled_documents(spark, sf), "doc_id")
    model = TM.fit(data.filter(F.col("split") == "train"), max_iter=20)
    test = data.filter(F.col("split") == "test")
    scored = TM.score(model, test, keep=["doc_id", "label"]).collect()
    assert scored and all(r.prediction in (0, 1, 2) for r in scored)
    assert all(r.p_sum == pytest.approx(1.0) for r in scored)
    assert {r.predicted for r in scored} <= {"Negative", "Positive", "Neutral"}
    path = str(tmp_path / "model")
    model.write().overwrite().save(path)
    again = TM.score(PipelineModel.load(path), test, keep=["doc_id"]).collect()
    assert sorted((r.doc_id, r.prediction) for r in again) == sorted((r.doc_id, r.prediction) for r in scored)


def test_builtin_tokens_equal_ml_transformers(spark, sf):
    from pyspark.ml.feature import Tokenizer
    docs = spark.createDataFrame(
        [(1, " A  b\tC. "), (2, ""), (3, "   "), (4, "The cat, and THE dog\n\n"), (5, "x\x0by")],
        "doc_id int, text string").unionByName(
        spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"))
    ours = {r.doc_id: (r.words, r.filtered) for r in TM.tokens(docs).collect()}
    ml = Tokenizer(inputCol="text", outputCol="words").transform(docs)
    ml = StopWordsRemover(inputCol="words", outputCol="filtered").transform(ml)
    theirs = {r.doc_id: (r.words, r.filtered) for r in ml.collect()}
    assert ours == theirs


def test_hashed_features_drop_no_term_and_accuracy(spark):
    from titlepulse.operators import text_model as TM

    rows = [(i, "good fine nice" if i % 2 else "bad poor awful", i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    for kw in ({}, {"vocab_size": 10}):
        model = TM.fit(df, **kw)
        scored = TM.score(model, df)
        assert TM.accuracy(scored).first()["accuracy"] == 1.0
        assert all(r.is_argmax and r.is_class and abs(r.p_sum - 1) < 1e-9 for r in TM.audited(model, df).collect())
    stats = TM.term_stats(TM.tokens(df))
    assert TM.dropped_terms(stats, 4) == 2 and {r.term: (r.tf, r.df) for r in stats.collect()}["good"] == (20, 20)


def test_term_stats_and_tfidf_by_hand(spark):
    import math

    from titlepulse.operators import text_model as TM

    df = spark.createDataFrame([(1, "x x y"), (2, "y"), (3, "")], "doc_id long, text string")
    tok = TM.tokens(df)
    assert {r.term: (r.tf, r.df) for r in TM.term_stats(tok).collect() if r.term} == {"x": (2, 1), "y": (2, 2)}
    got = {(r.doc_id, r.term): r.tfidf for r in TM.doc_tfidf(tok, 3).collect()}
    assert abs(got[1, "x"] - 2 * math.log(4 / 2)) < 1e-12 and abs(got[2, "y"] - math.log(4 / 3)) < 1e-12


def test_doc_tfidf_hashes_the_weights(spark):
    """Repeated and null ids: counts are summed by id, a term's df counts rows."""
    docs = spark.createDataFrame([(1, "fox fox red"), (1, "fox"), (None, "red"), (2, None)], "doc_id long, text string")
    df = TM.doc_tfidf(TM.tokens(docs), 4)
    assert "ShuffledHashJoin" in df._jdf.queryExecution().executedPlan().toString()
    got = {(r.doc_id, r.term): (r.tf, round(r.tfidf, 9)) for r in df.collect()}
    idf = {t: math.log(5 / (n + 1)) for t, n in (("fox", 2), ("red", 2), ("", 1))}
    exp = {(1, "fox"): 3, (1, "red"): 1, (None, "red"): 1, (2, ""): 1}
    assert got == {k: (n, round(n * idf[k[1]], 9)) for k, n in exp.items()}
