from pyspark.sql import functions as F

from titlepulse.functions import cleaning as C
from titlepulse.operators.clean import clean_actor, clean_movie, clean_review, with_reject_counts


def one(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn("x")).collect()]


def test_revenue(spark):
    got = one(spark, ["$28,767,189", "", None, "$2,923,706,026"], C.money_amount)
    assert got == [28767189, 0, None, 2923706026]


def test_budget(spark):
    got = one(spark, ["$25,000,000 (estimated)", "", "DEM 2,300,000", "₹60,000,000"], C.budget_amount)
    assert got == [25000000, 0, None, None]


def test_vote_count(spark):
    assert one(spark, ["3.1M", "957K", "812", None, "17.3M"], C.suffixed_count) == \
        [3100000, 957000, 0, 0, 17300000]
    plain = lambda c: C.suffixed_count(c, plain=True)
    assert one(spark, ["812", "1.2K"], plain) == [812, 1200]


def test_like(spark):
    assert one(spark, ["1.2K", "35 ", "", None, "n/a"], C.suffixed_number) == [1200, 35, 0, None, None]


def test_star(spark):
    assert one(spark, ["", "7", None, "x"], C.star_value) == [0, 7, None, None]


def test_list_chars(spark):
    assert one(spark, ['["A B","C"]'], C.strip_list_chars) == ["A B,C"]


def test_junk_filter(spark):
    df = spark.createDataFrame([("{a",), (None,), ("tt1",)], "movie_id string")
    m = df.select("movie_id", F.lit("").alias("revenue"), F.lit("").alias("budget"),
                  F.lit(None).cast("string").alias("vote_count"))
    assert [r.movie_id for r in clean_movie(m).collect()] == ["tt1"]
    a = spark.createDataFrame([("{x", "[]", "[]"), ("A01", '["a"]', '["b","c"]')],
                              "actor_id string, writers string, stars string")
    assert [(r.actor_id, r.stars) for r in clean_actor(a).collect()] == [("A01", "b,c")]


def test_reviews_not_junk_filtered(spark):
    r = spark.createDataFrame([("{r", "5", "1K", "2", "d")],
                              "review_id string, star string, like string, dislike string, date string")
    out = clean_review(r).collect()
    assert len(out) == 1 and out[0].like == 1000 and "date" not in clean_review(r).columns


def test_reject_counts(spark):
    raw = spark.createDataFrame([("$1", "DEM 2"), ("x", "$5"), ("", "")], "revenue string, budget string")
    observed, obs = with_reject_counts(raw, "movie")
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rejected_revenue": 1, "rejected_budget": 1}


def test_small_helpers(spark):
    df = spark.createDataFrame([(" a ", "", "b", "(1.2M)"), (None, None, "d", "7")],
                               "t string, w string, dm string, v string")
    rows = df.select(C.text_or_empty("t").alias("t"), C.first_present("w", "dm").alias("rev"),
                     C.strip_parens("v").alias("v"), C.content_id("dm", prefix="R").alias("id")).collect()
    assert [(r.t, r.rev, r.v) for r in rows] == [("a", "b", "1.2M"), ("", "d", "7")]
    assert rows[0].id.startswith("R") and len(rows[0].id) == 17 and rows[0].id != rows[1].id


def test_amounts_past_a_long_become_null(spark):
    from titlepulse.functions.cleaning import suffixed_count, suffixed_number

    rows = [("9999999999999999M", None), ("99999999999999999K", None), ("99999999999999999999", None), ("2M", 2000000)]
    df = spark.createDataFrame(rows, "v string, want long")
    got = df.select("want", suffixed_count("v", plain=True).alias("a")).collect()
    assert all(r.a == r.want for r in got)
    got = df.filter("v not like '%M'").select("want", suffixed_number("v").alias("a")).collect()
    assert all(r.a == r.want for r in got)
