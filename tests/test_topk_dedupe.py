from pyspark.sql import functions as F

from titlepulse.operators.dedupe import dedupe_latest
from titlepulse.operators.topk import top_k


def test_top_k_hot_key_matches_brute_force(spark):
    # key 0 holds a third of all rows
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"),
                                  ((F.col("id") * 7919) % 1000).alias("v"), F.col("id"))
    got = top_k(df, 5, [F.desc("v"), F.asc("id")], partition_by=["k"], rank_col="rk")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    pdf = df.toPandas().sort_values(["k", "v", "id"], ascending=[True, False, True])
    exp = pdf.groupby("k").head(5)
    assert sorted(map(tuple, exp[["k", "v", "id"]].values.tolist())) == \
        sorted((r.k, r.v, r.id) for r in got.collect())


def test_global_top_k(spark):
    df = spark.range(1000).select(((F.col("id") * 37) % 101).alias("v"), "id")
    got = [r.id for r in top_k(df, 3, [F.desc("v"), F.asc("id")]).collect()]
    pdf = df.toPandas().sort_values(["v", "id"], ascending=[False, True])
    assert got == pdf["id"].head(3).tolist()


def test_dedupe_keeps_smallest(spark):
    df = spark.createDataFrame([("r1", "m", 5, 3), ("r1", "m", 2, 9), ("r1", "m", None, 1), ("r2", "m", 1, 1)],
                               "review_id string, movie_id string, star int, like int")
    got = {r.review_id: (r.star, r.like) for r in
           dedupe_latest(df, ["review_id", "movie_id"], ["star", "like"]).collect()}
    assert got == {"r1": (None, 1), "r2": (1, 1)}
    last = {r.review_id: r.star for r in
            dedupe_latest(df, ["review_id", "movie_id"], ["star", "like"], keep="last").collect()}
    assert last["r1"] == 5
