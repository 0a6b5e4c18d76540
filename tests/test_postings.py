import random

import pytest
from pyspark.sql import functions as F

from titlepulse import fixtures as X
from titlepulse.operators import lookups as L
from titlepulse.operators.clean import clean_actor, clean_movie, clean_review
from titlepulse.operators.postings import search_bitmaps, search_grams, write_bitmap_index, write_gram_index


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_gram_search_equals_contains(spark, tmp_path):
    rnd = random.Random(3)
    names = ["".join(rnd.choice("abAB é😀") for _ in range(rnd.randrange(9))) for _ in range(300)]
    # a third of the rows have one name; repeated rows, an empty and a null name
    data = [(i, n) for i, n in enumerate(names + ["Anna Abba"] * 150 + ["", ""])] + [(0, names[0]), (900, None)]
    path = str(tmp_path / "grams")
    write_gram_index(spark.createDataFrame(data, "id long, name string"), "name", path)
    for term in ["", "a", "É", "ab", "bA", "aba", "😀", " a", "abb", "anna a", "zzz", "z", "b é"]:
        got = result(search_grams(spark, path, "name", term).select("id", "name"))
        assert got == sorted(((i, n) for i, n in data if n is not None and term.lower() in n.lower()), key=repr), term


def test_empty_gram_index(spark, tmp_path):
    path = str(tmp_path / "none")
    write_gram_index(spark.createDataFrame([], "id long, name string"), "name", path)
    assert search_grams(spark, path, "name", "abc").collect() == search_grams(spark, path, "name", "").collect() == []


def test_people_index_reads_postings_only(spark, sf, tmp_path):
    actor, movie = X.raw_actor(spark, sf), clean_movie(X.raw_movie(spark, sf))
    path = str(tmp_path / "people")
    L.index_people(actor, movie, path)
    for term in ["brand#1", "Supplier", "#", "no such name"]:
        assert result(L.indexed_person_search(spark, path, term)) == result(L.person_search(actor, movie, term)), term
    found = L.indexed_person_search(spark, path, "brand#1")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "EqualTo(gram," in plan and "Exchange" not in plan
    assert all("/people/postings/" in f for f in found.inputFiles())


def test_bitmaps_over_several_buckets(spark, tmp_path):
    rows = spark.range(70_000).select("id", (F.col("id") % 3).cast("string").alias("a"),
                                      F.when(F.col("id") % 7 > 0, F.concat(F.lit("v"), F.col("id") % 7)).alias("b"),
                                      F.concat(F.lit("Name "), F.col("id") % 1000).alias("c"))
    path = str(tmp_path / "bits")
    write_bitmap_index(rows, ["id"], ["a", "b"], path, names=("c",))
    got = {r.id for r in search_bitmaps(spark, path, {"a": ["1", "2"], "b": ["v1", "v5"]}, {"c": "name 99"}, F.col("id") > 10).collect()}
    want = {i for i in range(11, 70_000) if i % 3 in (1, 2) and i % 7 in (1, 5) and f"name {i % 1000}".startswith("name 99")}
    assert got == want and max(want) > 2 * 32768
    assert search_bitmaps(spark, path, {"a": ["9"]}).collect() == []
    assert search_bitmaps(spark, path).count() == 70_000


@pytest.mark.parametrize("args", [
    {}, {"min_rating": 4.0}, {"countries": ["NATION_1", "NATION_9"]}, {"sentiment": "Positive"}, {"director_contains": "SUPPLIER"},
    {"min_rating": 1.0, "countries": ["NATION_1", "NATION_2", "NATION_3"], "director_contains": "00", "sentiment": "Negative"},
])
def test_movie_index_equals_the_scan(spark, sf, movie_index, args):
    m, a, r, path = movie_index
    assert result(L.indexed_movie_filter(spark, path, **args)) == result(L.movie_filter(m, a, r, **args))


@pytest.fixture(scope="module")
def movie_index(spark, sf, tmp_path_factory):
    m, a, r = clean_movie(X.raw_movie(spark, sf)), clean_actor(X.raw_actor(spark, sf)), clean_review(X.raw_review(spark, sf))
    m = m.unionByName(m.limit(5))  # repeated rows are rows of their own
    path = str(tmp_path_factory.mktemp("movies") / "index")
    L.index_movies(m, a, r, path)
    return m, a, r, path
