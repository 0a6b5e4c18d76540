"""Plan guards: what every registered query may and may not compile to."""
import re

import pytest

import __spark_entry__ as E

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"]
# Queries that run a stream or fit a model first; their returned frame reads a
# sink / applies a fitted model, so they are checked on their own below.
SLOW = {"sentiment_predictions", "confusion_matrix", "score_documents", "stream_score", "model_weights"}


def plan_of(df):
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in E.queries() if not n.startswith("stream_") and n not in SLOW
                                        and not re.match(r"op\d+_|pipeline$", n)))
def test_no_cross_join_no_python(spark, sf, name):
    plan = plan_of(E.queries()[name](spark, sf))
    hits = [f for f in FORBIDDEN if f in plan]
    assert not hits, f"{name}: {hits}"


def test_flagship_join_plan(spark, sf):
    df = E.queries()["top_user_sentiment"](spark, sf)
    plan = plan_of(df)
    # lineitem is read with only the four columns the reviews are built from
    scans = re.findall(r"FileScan parquet [^\n]*lineitem[^\n]*", plan) or [plan]
    assert all("l_extendedprice" not in s and "l_shipdate" not in s for s in scans)
    # reviews are partially aggregated before the first shuffle
    assert "partial_count(review_id" in plan and "partial_sum(like" in plan


def test_model_queries_have_no_python(spark, sf):
    for name in ("score_documents",):
        plan = plan_of(E.queries()[name](spark, sf))
        assert not [f for f in FORBIDDEN if f in plan]
