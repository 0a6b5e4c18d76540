"""Repeated elements of pages as rows: links, list rows, review blocks.

A page is cut into tags and texts, and one ``aggregate`` walks its tags with a
stack: an end tag closes the nearest open element of its name and all that
were left open inside it, an end tag without a start is ignored, and what is
open at the end of the page ends there (what a lenient parser does). Elements
come out in the order of their start tags, nested ones too, with the text
between their tags and character references decoded once.

Built-in functions alone; a page is one row, nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlepulse.functions.cleaning import content_id, text_or_empty

# Elements without content, and elements whose content is no text.
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]
HIDDEN_RE = r"(?is)<!--.*?-->|<(script|style)\b[^>]*+>.*?</\1\s*>"
# Names of character references.
NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "copy": "©", "reg": "®", "hellip": "…",
         "mdash": "—", "ndash": "–", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”"}
#: A tag, a declaration, text, or a lone angle bracket. Quoted attribute values may hold '>'.
TOKEN_RE = r"""</?[A-Za-z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|<[!?][^>]*+>|[^<]++|<"""
REFERENCE_RE = r"&(?:[A-Za-z]++|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});|[^&]++|&"
LAST_CODE = 0x10FFFF


def decoded(text: Column) -> Column:
    """Character references decoded once; unknown names and numbers that are
    no character stay as they stand."""
    names = F.create_map(*[F.lit(x) for kv in NAMED.items() for x in kv])

    def one(t: Column) -> Column:
        body = F.substring(t, 2, 1 << 20)
        inner = F.regexp_extract(t, r"^&([A-Za-z]+);$", 1)
        ten = F.regexp_extract(body, r"^#([0-9]+);$", 1)
        hexa = F.regexp_extract(body, r"^#[xX]([0-9A-Fa-f]+);$", 1)
        code = F.when(ten != "", ten.try_cast("int")).otherwise(F.conv(F.nullif(hexa, F.lit("")), 16, 10).try_cast("int"))
        real = code.between(1, LAST_CODE) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, F.lit("0"))), "UTF-32")
        return F.when(~t.startswith("&") | (F.length(t) == 1), t).otherwise(F.coalesce(F.try_element_at(names, inner), F.when(real, char), t))

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(REFERENCE_RE), 0), one), "")


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a start tag, decoded; null where it is missing."""
    quoted = rf"""(?i)^<[^\s>]+(?:\s+[^\s=>]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?)*?\s+{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
    raw = F.regexp_extract(tag, quoted, 1)
    return F.when(raw != "", decoded(F.regexp_replace(raw, r"""^["']|["']$""", "")))


def tag_name(token: Column) -> Column:
    return F.lower(F.regexp_extract(token, r"^</?([A-Za-z][A-Za-z0-9:-]*)", 1))


def spans(tokens: Column, tags: list[str]) -> Column:
    """Array of (start, stop, tag): the places of the start tag and of the
    token that ends it (one past the last token where the page ends)."""
    wanted, void = F.array(*[F.lit(t) for t in tags]), F.array(*[F.lit(t) for t in VOID])
    marks = F.filter(F.transform(tokens, lambda t, i: F.struct((i + 1).alias("at"), tag_name(t).alias("tag"), t.startswith("</").alias("ends"),
                                                               t.endswith("/>").alias("alone"))),
                     lambda m: (m["tag"] != "") & (m["ends"] | ~m["alone"]) & ~F.array_contains(void, m["tag"]))
    opened = "array<struct<at:int,tag:string>>"
    closed = "array<struct<start:int,stop:int,tag:string>>"
    start = F.struct(F.array().cast(opened).alias("stack"), F.array().cast(closed).alias("done"))

    def ended(xs: Column, stop: Column) -> Column:
        return F.transform(F.filter(xs, lambda x: F.array_contains(wanted, x["tag"])),
                           lambda x: F.struct(x["at"].alias("start"), stop.alias("stop"), x["tag"].alias("tag")))

    def step(s: Column, m: Column) -> Column:
        stack, done = s["stack"], s["done"]
        near = F.array_position(F.reverse(F.transform(stack, lambda x: x["tag"])), m["tag"])  # 0: none is open
        keep = (F.size(stack) - near).cast("int")
        push = F.struct(F.array_append(stack, F.struct(m["at"].alias("at"), m["tag"].alias("tag"))).alias("stack"), done.alias("done"))
        pop = F.struct(F.slice(stack, 1, keep).alias("stack"),
                       F.concat(done, ended(F.slice(stack, keep + 1, near.cast("int")), m["at"])).alias("done"))
        return F.when(~m["ends"], push).when(near > 0, pop).otherwise(s)

    return F.aggregate(marks, start, step, lambda s: F.array_sort(F.concat(s["done"], ended(s["stack"], (F.size(tokens) + 1).cast("int")))))


def elements(pages: DataFrame, tags: list[str], html: str = "html") -> DataFrame:
    """One row per element of the named tags: all columns of pages but the
    page itself, with k (1, 2, ... in page order), tag, text and href, the
    first link in the element or on its own tag (null where there is none).

    Null and empty pages have no elements; text is trimmed, hidden content
    (comments, scripts, styles) is none of it."""
    keep = [c for c in pages.columns if c != html]
    # A generator's column is computed once; the tokens are used several times below.
    cut = pages.select(*keep, F.explode(F.array(F.regexp_extract_all(F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN_RE, ""), F.lit(TOKEN_RE), 0))).alias("_t"))
    rows = cut.select(*keep, "_t", F.posexplode(spans(F.col("_t"), [t.lower() for t in tags])).alias("_k", "_e"))
    inside = F.slice("_t", F.col("_e.start") + 1, F.col("_e.stop") - F.col("_e.start") - 1)
    own = F.slice("_t", F.col("_e.start"), F.col("_e.stop") - F.col("_e.start"))
    body = F.array_join(F.filter(inside, lambda t: (tag_name(t) == "") & ~t.startswith("<!") & ~t.startswith("<?")), "")
    links = F.filter(F.transform(F.filter(own, lambda t: ~t.startswith("</") & (tag_name(t) == "a")), lambda t: attribute(t, "href")), lambda h: h.isNotNull())
    return rows.select(*keep, (F.col("_k") + 1).alias("k"), F.col("_e.tag").alias("tag"),
                       F.btrim(decoded(body), F.lit(" \t\n\r\u000b\u000c")).alias("text"), F.get(links, 0).alias("href"))


def list_rows(pages: DataFrame, tags: list[str], first: int | None = None, key: str = "page_id", html: str = "html") -> DataFrame:
    """The rows of each page's lists: the first ``first`` elements of the
    named tags, those without a link skipped after that, under an id of
    their content, with the link cut before its query."""
    rows = elements(pages, tags, html)
    if first is not None:
        rows = rows.filter(F.col("k") <= first)
    link = F.split_part("href", F.lit("?"), F.lit(1))
    return rows.filter("href is not null").select(key, "k", "tag", "text", link.alias("link"), content_id(key, "k", "text", link, prefix="L").alias("row_id"))


def blocks(pages: DataFrame, tags: list[str], key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per text block (review, paragraph, heading), under an id of its content."""
    return elements(pages, tags, html).select(key, "k", "tag", "text", content_id(key, "tag", "k", "text", prefix="B").alias("block_id"))


def first_texts(pages: DataFrame, tags: list[str], key: str = "page_id", html: str = "html") -> DataFrame:
    """Per page the text of the first element of each tag, or the empty text."""
    found = elements(pages.select(key, html), tags, html).groupBy(F.col(key).alias("_p")).agg(
        *[F.min_by(F.when(F.col("tag") == t, F.col("text")), F.when(F.col("tag") == t, F.col("k"))).alias(t) for t in tags])
    return pages.select(key).join(found, F.col(key) == F.col("_p"), "left").select(key, *[text_or_empty(t).alias(t) for t in tags])
