"""Cleaning of text-typed money, vote, star and like fields.

All parsing goes through ``try_cast`` so one bad value turns into null (and is
counted by ``reject_counts``) instead of failing the whole job under ANSI mode.
Suffix arithmetic is decimal, not double, so ``17.3M`` is exactly 17,300,000.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DEC = "decimal(24,6)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_junk(id_col) -> Column:
    """Junk filter: ids starting with ``{`` are dropped; null ids are dropped too."""
    return ~_c(id_col).startswith("{")


def money_amount(c) -> Column:
    """``$28,767,189`` -> 28767189; blank -> 0; null -> null; other text -> null."""
    s = F.trim(F.regexp_replace(_c(c), r"[$,]", ""))
    return F.when(s == "", F.lit(0).cast("bigint")).otherwise(s.try_cast("bigint"))


def budget_amount(c) -> Column:
    """First space-separated token as money: ``$25,000,000 (estimated)`` -> 25000000.

    Blank -> 0. A non-dollar amount (``DEM 2,300,000``) gives null.
    """
    c = _c(c)
    first = F.split(F.when(c == "", F.lit("0")).otherwise(c), " ").getItem(0)
    return F.trim(F.regexp_replace(first, r"[$,]", "")).try_cast("bigint")


def suffixed_count(c, plain: bool = False) -> Column:
    """Vote count: ``3.1M`` -> 3100000, ``957K`` -> 957000.

    Anything else is 0 (null too), as the original cleaning does; with
    ``plain=True`` an unsuffixed number is parsed instead.
    """
    c = _c(c)
    m = F.regexp_replace(c, "M", "").try_cast(_DEC) * F.lit(1000000)
    k = F.regexp_replace(c, "K", "").try_cast(_DEC) * F.lit(1000)
    other = F.trim(c).try_cast(_DEC) if plain else F.lit(0)
    return F.when(c.endswith("M"), m).when(c.endswith("K"), k).otherwise(other).try_cast("bigint")


def suffixed_number(c) -> Column:
    """Like / dislike: ``1.2K`` -> 1200, blank -> 0, ``35 `` -> 35, null -> null."""
    c = _c(c)
    k = F.trim(F.regexp_replace(c, "K", "")).try_cast(_DEC) * F.lit(1000)
    return (F.when(c.endswith("K"), k).when(c == "", F.lit(0))
            .otherwise(F.trim(c).try_cast(_DEC)).try_cast("bigint"))


def star_value(c) -> Column:
    """Star: blank -> 0, else integer (null stays null, bad text -> null)."""
    c = _c(c)
    return F.when(c == "", F.lit("0")).otherwise(c).try_cast("int")


def strip_list_chars(c) -> Column:
    """``["A B","C"]`` -> ``A B,C`` (removes brackets and double quotes)."""
    return F.regexp_replace(_c(c), r'[\[\]"]', "")


def rejected(raw, cleaned) -> Column:
    """True when a non-null raw value did not parse."""
    return _c(raw).isNotNull() & _c(cleaned).isNull()


def text_or_empty(c) -> Column:
    """Trimmed text; a missing element counts as the empty text."""
    return F.coalesce(F.trim(_c(c)), F.lit(""))


def first_present(primary, fallback) -> Column:
    """``primary`` unless it is missing or blank, else ``fallback`` (worldwide
    gross, else domestic gross)."""
    return F.coalesce(F.nullif(F.trim(_c(primary)), F.lit("")), _c(fallback))


def strip_parens(c) -> Column:
    """``(1.2M)`` -> ``1.2M``: parentheses removed from both ends."""
    return F.btrim(_c(c), F.lit("()"))


def content_id(*cols, prefix: str = "", length: int = 16) -> Column:
    """A stable id from the content of the given columns, so a re-crawl of the
    same record gets the same id (sequence ids restart per crawl)."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("\u0001", *parts), 256), 1, length))
