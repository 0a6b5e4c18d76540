"""clean_movie / clean_actor / clean_review: one projection each.

Each is a single ``select`` (no chain of ``withColumn``), works on batch and
streaming frames alike, and passes through columns it does not know (for
example the message timestamp).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from titlepulse.functions import cleaning as C


def _replace(df: DataFrame, new: dict) -> DataFrame:
    return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


def clean_movie(movie: DataFrame, plain_counts: bool = False) -> DataFrame:
    new = {"revenue": C.money_amount("revenue"), "budget": C.budget_amount("budget"),
           "vote_count": C.suffixed_count("vote_count", plain=plain_counts)}
    if "year" in movie.columns and dict(movie.dtypes)["year"] == "string":
        new["year"] = F.col("year").try_cast("int")
    if "rating" in movie.columns and dict(movie.dtypes)["rating"] != "double":
        new["rating"] = F.col("rating").try_cast("double")
    return _replace(movie.filter(C.not_junk("movie_id")), new)


def clean_actor(actor: DataFrame) -> DataFrame:
    new = {"writers": C.strip_list_chars("writers"), "stars": C.strip_list_chars("stars")}
    return _replace(actor.filter(C.not_junk("actor_id")), new)


def clean_review(review: DataFrame) -> DataFrame:
    new = {"star": C.star_value("star"), "like": C.suffixed_number("like"),
           "dislike": C.suffixed_number("dislike")}
    out = _replace(review, new)
    return out.drop("date") if "date" in out.columns else out


def _reject_counts(kind: str) -> list:
    checks = {
        "movie": {"revenue": C.money_amount, "budget": C.budget_amount},
        "review": {"star": C.star_value, "like": C.suffixed_number, "dislike": C.suffixed_number},
    }.get(kind, {})
    return [F.sum(C.rejected(c, fn(c)).cast("long")).alias(f"rejected_{c}") for c, fn in checks.items()]


def observed_rejects(raw: DataFrame, kind: str) -> DataFrame:
    """The same frame, which reports values that did not parse as the metrics
    ``rejects_<kind>`` with each batch of a stream; a kind without numbers is
    left as it is."""
    aggs = _reject_counts(kind)
    return raw.observe(f"rejects_{kind}", *aggs) if aggs else raw


def with_reject_counts(raw: DataFrame, kind: str, name: str | None = None):
    """Attach an ``Observation`` counting values that did not parse.

    Returns ``(observed_raw_frame, observation)``; the counts are filled in by
    whatever action runs the frame, without an extra pass.
    """
    obs = Observation(name or f"rejects_{kind}")
    return raw.observe(obs, *_reject_counts(kind)), obs
