from titlepulse.functions.labels import (
    label_name, sentiment_indicators, sentiment_label, sentiment_number,
)
from titlepulse.schemas import LABEL_OF


def test_labels(spark):
    df = spark.createDataFrame([(None,), (0,), (4,), (5,), (7,), (8,), (10,)], "star int")
    rows = df.select("star", sentiment_label().alias("s"), sentiment_number().alias("n"),
                     *sentiment_indicators()).collect()
    got = {r.star: (r.s, r.n, r.Positive, r.Neutral, r.Negative) for r in rows}
    assert got[None] == ("Negative", 0, 0, 0, 0)  # null: Negative label, no indicator
    assert got[0] == ("Negative", 0, 0, 0, 1)
    assert got[5] == ("Neutral", 2, 0, 1, 0)
    assert got[8] == ("Positive", 1, 1, 0, 0)


def test_label_round_trip(spark):
    df = spark.createDataFrame([(float(v),) for v in LABEL_OF.values()], "prediction double")
    names = [r[0] for r in df.select(label_name()).collect()]
    assert names == list(LABEL_OF.keys())
