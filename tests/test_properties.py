"""Property tests: formatted numbers parse back exactly (one Spark job per example batch)."""
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from titlepulse.functions import cleaning as C

money = st.integers(min_value=0, max_value=9_000_000_000_000)
suffixed = st.tuples(st.integers(min_value=0, max_value=99_999), st.integers(min_value=0, max_value=99),
                     st.sampled_from(["K", "M"]))


def run(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(fn("x")).collect()]


@settings(max_examples=5, deadline=None)
@given(st.lists(money, min_size=1, max_size=50))
def test_money_round_trip(spark, amounts):
    text = [f"${a:,}" for a in amounts]
    assert run(spark, text, C.money_amount) == amounts
    assert run(spark, [t + " (estimated)" for t in text], C.budget_amount) == amounts


@settings(max_examples=5, deadline=None)
@given(st.lists(suffixed, min_size=1, max_size=50))
def test_suffixed_round_trip(spark, parts):
    text = [f"{i}.{f:02d}{s}" for i, f, s in parts]
    scale = {"K": 1000, "M": 1_000_000}
    expect = [int(Decimal(f"{i}.{f:02d}") * scale[s]) for i, f, s in parts]
    assert run(spark, text, C.suffixed_count) == expect
    assert run(spark, [t if t.endswith("K") else t for t in text if t.endswith("K")], C.suffixed_number) == \
        [e for e, t in zip(expect, text) if t.endswith("K")]
