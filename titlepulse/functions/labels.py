"""Sentiment labels derived from the star rating."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from titlepulse.schemas import LABEL_OF, NEUTRAL_MIN_STAR, POSITIVE_MIN_STAR


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sentiment_label(star="star") -> Column:
    """Positive (>= 8), Neutral (>= 5), else Negative. Null and 0 stars are Negative."""
    s = _c(star)
    return (F.when(s >= POSITIVE_MIN_STAR, F.lit("Positive"))
            .when(s >= NEUTRAL_MIN_STAR, F.lit("Neutral")).otherwise(F.lit("Negative")))


def sentiment_number(star="star") -> Column:
    """Numeric training label with the same thresholds (null star -> Negative)."""
    s = _c(star)
    return (F.when(s >= POSITIVE_MIN_STAR, F.lit(LABEL_OF["Positive"]))
            .when(s >= NEUTRAL_MIN_STAR, F.lit(LABEL_OF["Neutral"]))
            .otherwise(F.lit(LABEL_OF["Negative"])))


def sentiment_indicators(star="star") -> list[Column]:
    """0/1 columns Positive, Neutral, Negative. A null star counts in none of them."""
    s = _c(star)
    return [F.when(s >= POSITIVE_MIN_STAR, 1).otherwise(0).alias("Positive"),
            F.when((s >= NEUTRAL_MIN_STAR) & (s < POSITIVE_MIN_STAR), 1).otherwise(0).alias("Neutral"),
            F.when(s < NEUTRAL_MIN_STAR, 1).otherwise(0).alias("Negative")]


def label_name(prediction="prediction") -> Column:
    """Numeric label / prediction back to its name, with the same constant."""
    m = F.create_map(*[x for k, v in sorted(LABEL_OF.items(), key=lambda kv: kv[1])
                       for x in (F.lit(v), F.lit(k))])
    return F.try_element_at(m, _c(prediction).cast("int"))
