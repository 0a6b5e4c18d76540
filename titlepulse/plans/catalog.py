"""Named queries and their DuckDB oracle SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> str``.
Every query reads the whole test tables (through the fixtures) so its work
grows with them. Doubles are rounded to 6 places (correlations 9) on both
sides; integer sums are BIGINT on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = decimal_rounding(oracle)
        return fn
    return deco


def round_exact(c, places: int) -> F.Column:
    """Round a double half-up through an exact decimal, then back to double.

    Averages of quarter-point ratings often end exactly on a half at the 7th
    decimal; rounding the binary double (just below or above that half) would
    then depend on its last bit, which differs between engines and summation
    orders. Rounding its decimal value with 6 extra digits does not. NaN,
    infinities and nulls pass through."""
    c = F.col(c) if isinstance(c, str) else c
    exact = F.round(c.cast(f"decimal(38,{places + 6})"), places).cast("double")
    return F.when(F.abs(c) < 1e20, exact).otherwise(c)


def rounded(df: DataFrame, places: int = 6, cols: list[str] | None = None) -> DataFrame:
    """Round every double column (or the given ones), keeping column order."""
    targets = set(cols) if cols is not None else {c for c, t in df.dtypes if t in ("double", "float")}
    return df.select(*[round_exact(c, places).alias(c) if c in targets else F.col(c)
                       for c in df.columns])


def decimal_rounding(sql: str) -> str:
    """Rewrite every ``round(expr, p)`` of an oracle query to the same
    decimal rounding as ``round_exact`` (idempotent)."""
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        prev = sql[j - 1] if j else " "
        if prev.isalnum() or prev == "_" or low[max(0, j - 12):j].endswith("/*exact*/"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 1, j + 6, -1
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        expr = decimal_rounding(sql[j + 6:comma])
        places = int(sql[comma + 1:k - 1].strip())
        out.append(sql[i:j])
        out.append(f"(CASE WHEN abs({expr}) < 1e20 THEN CAST(/*exact*/round(CAST({expr} AS "
                   f"DECIMAL(38,{places + 6})), {places}) AS DOUBLE) ELSE {expr} END)")
        i = k


# Import the modules that register queries (order = registration order).
from titlepulse.plans import core_queries  # noqa: E402,F401
from titlepulse.plans import ingest_queries  # noqa: E402,F401
from titlepulse.plans import element_queries  # noqa: E402,F401
from titlepulse.plans import mining_queries  # noqa: E402,F401
from titlepulse.plans import text_queries  # noqa: E402,F401
from titlepulse.plans import stream_queries  # noqa: E402,F401
