"""Ingestion shaping: tagged JSON lines, routing, HTML field extraction, list ops.

The crawler's per-page Python (BeautifulSoup on one page at a time) is
re-aimed as table jobs over a ``pages`` table: every field is a JVM-side
regex column, so extraction runs in whole-stage codegen over any number of
pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from titlepulse.schemas import ID_COLUMNS

# Extraction patterns (Java regex; the same text runs on RE2).
TITLE_RE = r"(?s)<title[^>]*>(.*?)</title>"
H1_RE = r"(?s)<h1[^>]*>(.*?)</h1>"
LANG_RE = r'<html[^>]*\slang="([^"]*)"'
LINK_RE = r'<a\s[^>]*href="([^"]*)"'
ARTICLE_RE = r"(?s)<article[^>]*>(.*?)</article>"
TAG_RE = r"<[^>]*>"
HOST_RE = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)"


# ---------------------------------------------------------------- tag / route
def tag_records(df: DataFrame, tag: str) -> DataFrame:
    """One JSON line per record with its kind in ``_type``."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns],
                                        F.lit(tag).alias("_type"))).alias("line"))


def tag_union(frames: dict[str, DataFrame]) -> DataFrame:
    """Tag each frame and union them into one mixed stream of lines."""
    out = None
    for tag, df in frames.items():
        t = tag_records(df, tag)
        out = t if out is None else out.unionByName(t)
    return out


def line_type(line="line") -> Column:
    return F.get_json_object(F.col(line), "$._type")


def route_by_tag(lines: DataFrame, tag: str, schema: T.StructType, line: str = "line") -> DataFrame:
    """Keep the lines of one kind and parse them with that kind's schema."""
    return (lines.filter(line_type(line) == tag)
            .select(F.from_json(F.col(line), schema).alias("_r")).select("_r.*"))


def line_ids(lines: DataFrame, line: str = "line") -> DataFrame:
    """(_type, record_id) of every tagged line."""
    t = line_type(line)
    rid = F.coalesce(*[F.when(t == k, F.get_json_object(F.col(line), f"$.{v}"))
                       for k, v in ID_COLUMNS.items()])
    return lines.select(t.alias("_type"), rid.alias("record_id"))


# ---------------------------------------------------------------- HTML pages
def page_fields(pages: DataFrame, html: str = "html") -> DataFrame:
    """title, h1, lang, link count and article text length of each page.

    A missing element gives the empty string.
    """
    h = F.col(html)
    article = F.regexp_extract(h, ARTICLE_RE, 1)
    text = F.trim(F.regexp_replace(article, TAG_RE, ""))
    keep = [c for c in pages.columns if c != html]
    return pages.select(*keep,
                        F.trim(F.regexp_extract(h, TITLE_RE, 1)).alias("title"),
                        F.trim(F.regexp_extract(h, H1_RE, 1)).alias("h1"),
                        F.regexp_extract(h, LANG_RE, 1).alias("lang"),
                        F.size(F.regexp_extract_all(h, F.lit(LINK_RE), 1)).alias("n_links"),
                        F.length(text).alias("article_chars"))


def url_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """URL without its query, the path segment before the last, and the host."""
    base = F.split_part(F.col(url), F.lit("?"), F.lit(1))
    return pages.select(*[c for c in pages.columns if c in ("page_id",)],
                        base.alias("url_base"),
                        F.try_element_at(F.split(base, "/"), F.lit(-2)).alias("path_id"),
                        F.regexp_extract(F.col(url), HOST_RE, 1).alias("host"))


# ---------------------------------------------------------------- list ops
def list_ops(actor: DataFrame) -> DataFrame:
    """Credits as real arrays: first three stars, credits 2..4 without the lead
    star, and the stars padded to three slots (null past the end)."""
    arr = T.ArrayType(T.StringType())
    stars = F.from_json("stars", arr)
    writers = F.from_json("writers", arr)
    credits = F.concat(F.array(F.col("director")), writers)
    lead = F.get(stars, 0)
    return actor.select(
        "actor_id",
        F.array_join(F.slice(stars, 1, 3), "|").alias("top_stars"),
        F.array_join(F.filter(F.slice(credits, 2, 3), lambda x: x != lead), "|").alias("writers_wo_lead"),
        F.get(stars, 0).alias("star_1"), F.get(stars, 1).alias("star_2"),
        F.get(stars, 2).alias("star_3"), F.size(stars).alias("n_stars"))
