import re

import __spark_entry__ as E

#: Queries of the training-data subpackage, which may be absent.
OTHER = re.compile(r"op\d+_|pipeline$")


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["country", "language", "movie_ts", "avg_rating", "total_revenue",
                          "total_movie", "total_budget", "avg_profit"]


def test_every_query_has_an_oracle():
    q, o = E.queries(), E.oracle_sql()
    own = {n for n in q if not OTHER.match(n)}
    assert own <= set(o) and set(o) <= set(q) and len(own) >= 51
