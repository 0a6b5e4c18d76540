"""Repeated elements of pages: list rows, text blocks, first elements.

The oracles do not walk a stack: tags are numbered, a running balance per tag
gives their level, and an element ends at the next end tag of its level, or
where its article ends.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from titlepulse import fixtures as X
from titlepulse.functions import cleaning as C
from titlepulse.operators import elements as EL
from titlepulse.plans.catalog import register

LIST_TAGS = ["li", "div"]
BLOCK_TAGS = ["h1", "p"]
#: An ad stands behind the six links of a page, so the seventh row has no link.
FIRST = 7

_SEEN = r"""
WITH seen AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), '<script.*?</script>', '', 'gs'), '<style.*?</style>', '', 'gs') AS h FROM pages),
parts AS (SELECT page_id, h, regexp_extract_all(h, '<[^>]*>') AS tags, string_split_regex(h, '<[^>]*>') AS texts FROM seen),
tag AS (SELECT page_id, i, t, regexp_extract(t, '^</?([a-z0-9]+)', 1) AS name, t LIKE '</%' AS ends
        FROM (SELECT page_id, tags, unnest(range(1, len(tags) + 1)) AS i, unnest(tags) AS t FROM parts)),
last AS (SELECT page_id, max(i) AS i FROM tag WHERE t = '</article>' GROUP BY page_id),
lev AS (SELECT *, sum(CASE WHEN ends THEN -1 ELSE 1 END) OVER (PARTITION BY page_id, name ORDER BY i) + CASE WHEN ends THEN 1 ELSE 0 END AS level
        FROM tag WHERE name IN ('li', 'div', 'h1', 'p', 'title')),
span AS (SELECT o.page_id, o.name, o.t, o.i AS a, coalesce((SELECT min(c.i) FROM lev c WHERE c.page_id = o.page_id AND c.name = o.name AND c.level = o.level AND c.ends AND c.i > o.i
                 AND (o.i > last.i OR c.i < last.i)), last.i) AS z
         FROM lev o LEFT JOIN last USING (page_id) WHERE NOT o.ends),
el AS (SELECT page_id, name AS tag, a, trim(replace(replace(replace(replace(array_to_string(texts[a + 1:z], ''), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'),
              ' ' || chr(9) || chr(10) || chr(13)) AS text, array_to_string(tags[a:z], '') AS inner_tags
       FROM span JOIN parts USING (page_id))"""


@register("page_list_rows", _SEEN + f""",
n AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY a) AS k, regexp_extract(inner_tags, '<a [^>]*href="([^"?]*)', 1) AS link FROM el WHERE tag IN ('li', 'div'))
SELECT page_id, cast(k AS INTEGER) AS k, tag, text, link,
  'L' || substr(sha256(page_id || chr(1) || k || chr(1) || text || chr(1) || link), 1, 16) AS row_id
FROM n WHERE k <= {FIRST} AND inner_tags LIKE '%<a %'""")
def q_page_list_rows(spark, d):
    """The first rows of each page's lists; rows without a link are skipped."""
    return EL.list_rows(X.table(spark, d, "pages").select("page_id", "html"), LIST_TAGS, FIRST)


@register("page_blocks", _SEEN + """,
n AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY a) AS k FROM el WHERE tag IN ('h1', 'p'))
SELECT page_id, cast(k AS INTEGER) AS k, tag, text, 'B' || substr(sha256(page_id || chr(1) || tag || chr(1) || k || chr(1) || text), 1, 16) AS block_id FROM n""")
def q_page_blocks(spark, d):
    """One row per heading and paragraph, nested and unclosed ones included."""
    return EL.blocks(X.table(spark, d, "pages").select("page_id", "html"), BLOCK_TAGS)


@register("page_first_texts", _SEEN + """,
f AS (SELECT page_id, tag, text, row_number() OVER (PARTITION BY page_id, tag ORDER BY a) AS k FROM el)
SELECT page_id, coalesce(max(text) FILTER (WHERE tag = 'title'), '') AS title, coalesce(max(text) FILTER (WHERE tag = 'h1'), '') AS h1, '' AS em
FROM pages LEFT JOIN (SELECT * FROM f WHERE k = 1) USING (page_id) GROUP BY page_id""")
def q_page_first_texts(spark, d):
    """The first title, heading and emphasis of each page, or the empty text."""
    return EL.first_texts(X.table(spark, d, "pages").select("page_id", "html"), ["title", "h1", "em"])


@register("field_rules", """
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN cast(p_size AS VARCHAR) ELSE p_brand END AS gross,
  cast(p_size AS VARCHAR) || 'K' AS votes, CASE WHEN p_size % 2 = 0 THEN '' ELSE trim(p_name) END AS first_text
FROM part""")
def q_field_rules(spark, d):
    """Fallback of a blank field, parentheses around counts, missing texts."""
    p = X.table(spark, d, "part").select("p_partkey", "p_size", "p_brand", "p_name")
    size = F.col("p_size").cast("string")
    blank = F.when(F.col("p_size") % 3 == 0, F.lit(" ")).when(F.col("p_size") % 3 == 1, F.lit("")).otherwise(F.lit(None).cast("string"))
    gross = C.first_present(F.when(F.col("p_size") % 3 == 0, size).otherwise(blank), F.col("p_brand"))
    return p.select("p_partkey", gross.alias("gross"), C.strip_parens(F.concat(F.lit("("), size, F.lit("K)"))).alias("votes"),
                    C.text_or_empty(F.when(F.col("p_size") % 2 == 1, F.concat(F.lit("  "), "p_name", F.lit(" ")))).alias("first_text"))
