"""Tokens, term statistics, IDF, the key-hash split and the sentiment model."""

from __future__ import annotations

from pyspark.sql import functions as F

from titlepulse import fixtures as X
from titlepulse.functions.text import ENGLISH_STOP_WORDS, sql_list
from titlepulse.operators import term_model as TW
from titlepulse.operators import text_model as TM
from titlepulse.plans.catalog import register, rounded

_STOP_SQL = sql_list(ENGLISH_STOP_WORDS)
_WS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

# Java's String.split drops trailing empty tokens (and returns nothing for an
# all-whitespace text); DuckDB's split keeps them, so trailing whitespace is
# trimmed first.
_TOKENS_SQL = f"""
lo AS (SELECT doc_id, lower(coalesce(text, '')) AS s FROM documents),
tok AS (SELECT doc_id,
          CASE WHEN length(s) > 0 AND rtrim(s, {_WS}) = '' THEN []::VARCHAR[]
               ELSE string_split_regex(rtrim(s, {_WS}), '[ \\t\\n\\x0B\\f\\r]') END AS words
        FROM lo),
flt AS (SELECT doc_id, words, list_filter(words, lambda x: NOT list_contains({_STOP_SQL}, x)) AS filtered
        FROM tok)"""

# Document classes from the label table.
_LABEL_SQL = "CASE WHEN quality = 1 AND toxic = 0 THEN 1 WHEN quality = 1 AND toxic = 1 THEN 2 ELSE 0 END"


def doc_label():
    q, t = F.col("quality"), F.col("toxic")
    return F.when((q == 1) & (t == 0), 1).when((q == 1) & (t == 1), 2).otherwise(0)


def labeled_documents(spark, d):
    docs = X.table(spark, d, "documents").select("doc_id", "text")
    labels = X.table(spark, d, "labels").select("doc_id", doc_label().alias("label"))
    return docs.join(labels, "doc_id")


@register("tokens", "WITH " + _TOKENS_SQL + """
SELECT doc_id, cast(len(words) AS bigint) AS n_words, cast(len(filtered) AS bigint) AS n_filtered,
  array_to_string(filtered, ' ') AS filtered_text FROM flt""")
def q_tokens(spark, d):
    t = TM.tokens(X.table(spark, d, "documents").select("doc_id", "text"))
    return t.select("doc_id", F.size("words").cast("bigint").alias("n_words"),
                    F.size("filtered").cast("bigint").alias("n_filtered"),
                    F.array_join("filtered", " ").alias("filtered_text"))


@register("term_counts", "WITH " + _TOKENS_SQL + """,
u AS (SELECT doc_id, unnest(filtered) AS term FROM flt)
SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM u GROUP BY term""")
def q_term_counts(spark, d):
    t = TM.tokens(X.table(spark, d, "documents").select("doc_id", "text"))
    return TM.term_stats(t)


@register("tfidf_weights", "WITH " + _TOKENS_SQL + """,
u AS (SELECT doc_id, unnest(filtered) AS term FROM flt),
n AS (SELECT count(*) AS nd FROM documents)
SELECT term, count(DISTINCT doc_id) AS df,
  round(ln(cast(nd + 1 AS double) / (count(DISTINCT doc_id) + 1)), 9) AS idf
FROM u CROSS JOIN n GROUP BY term, nd""")
def q_tfidf_weights(spark, d):
    docs = X.table(spark, d, "documents").select("doc_id", "text")
    stats = TM.term_stats(TM.tokens(docs))
    return rounded(TM.idf_weights(stats, docs.agg(F.count(F.lit(1))).scalar()), 9)


@register("split_train_test", f"""
SELECT doc_id, {_LABEL_SQL} AS label,
  CASE WHEN ('0x' || substr(md5(cast(doc_id AS varchar)), 1, 8))::BIGINT % 100 < 80
       THEN 'train' ELSE 'test' END AS split
FROM documents JOIN labels USING (doc_id)""")
def q_split_train_test(spark, d):
    return TM.key_split(labeled_documents(spark, d), "doc_id").select("doc_id", "label", "split")


@register("doc_term_counts", "WITH " + _TOKENS_SQL + """,
u AS (SELECT doc_id, unnest(filtered) AS term FROM flt)
SELECT doc_id, term, count(*) AS tf FROM u GROUP BY doc_id, term""")
def q_doc_term_counts(spark, d):
    return TM.doc_terms(TM.tokens(X.table(spark, d, "documents").select("doc_id", "text")))


@register("doc_tfidf", "WITH " + _TOKENS_SQL + """,
u AS (SELECT doc_id, unnest(filtered) AS term FROM flt),
n AS (SELECT count(*) AS nd FROM documents),
t AS (SELECT term, ln(cast(nd + 1 AS double) / (count(DISTINCT doc_id) + 1)) AS idf FROM u CROSS JOIN n GROUP BY term, nd)
SELECT doc_id, term, count(*) AS tf, round(count(*) * any_value(idf), 9) AS tfidf
FROM u JOIN t USING (term) GROUP BY doc_id, term""")
def q_doc_tfidf(spark, d):
    docs = X.table(spark, d, "documents").select("doc_id", "text")
    return rounded(TM.doc_tfidf(TM.tokens(docs), docs.agg(F.count(F.lit(1))).scalar()), 9, ["tfidf"])


# The oracle of the weights: the same convex problem by another solver, an
# accelerated gradient descent in a recursive query. L = 1 + ridge bounds the
# curvature of unit vectors with a constant.
_K = TW.TERMS
_STEPS = 700
BIG = 1 + TW.RIDGE
BETA = (1 - (TW.RIDGE / BIG) ** 0.5) / (1 + (TW.RIDGE / BIG) ** 0.5)
_MODEL_SQL = "WITH RECURSIVE " + _TOKENS_SQL + f""",
lab AS (SELECT doc_id, filtered, {_LABEL_SQL} AS label,
          ('0x' || substr(md5(cast(doc_id AS varchar)), 1, 8))::BIGINT % 100 < 80 AS train
        FROM flt JOIN labels USING (doc_id)),
tot AS (SELECT count(*) AS n, count(*) FILTER (WHERE label = 0) AS c0, count(*) FILTER (WHERE label = 1) AS c1,
          count(*) FILTER (WHERE label = 2) AS c2 FROM lab WHERE train),
seen AS (SELECT term, count(*) AS df, count(*) FILTER (WHERE label = 0) AS n0, count(*) FILTER (WHERE label = 1) AS n1,
          count(*) FILTER (WHERE label = 2) AS n2
         FROM (SELECT label, unnest(list_distinct(filtered)) AS term FROM lab WHERE train) GROUP BY term),
shares AS (SELECT term, df, coalesce(n0 / nullif(c0, 0)::DOUBLE, 0) AS s0, coalesce(n1 / nullif(c1, 0)::DOUBLE, 0) AS s1,
             coalesce(n2 / nullif(c2, 0)::DOUBLE, 0) AS s2, n FROM seen CROSS JOIN tot),
terms AS (SELECT term, ln((n + 1)::DOUBLE / (df + 1)) AS idf, row_number() OVER (ORDER BY greatest(s0, s1, s2) - least(s0, s1, s2) DESC, term) AS j
          FROM shares ORDER BY greatest(s0, s1, s2) - least(s0, s1, s2) DESC, term LIMIT {_K}),
hit AS (SELECT doc_id, j, count(*) * any_value(idf) AS v FROM (SELECT doc_id, unnest(filtered) AS term FROM flt) JOIN terms USING (term) GROUP BY doc_id, j),
len AS (SELECT doc_id, sqrt(sum(v * v)) AS norm FROM hit GROUP BY doc_id),
cell AS (SELECT f.doc_id, r.j, coalesce(h.v / l.norm, 0) AS v FROM flt f CROSS JOIN (SELECT unnest(range(1, {_K} + 1)) AS j) r
         LEFT JOIN hit h ON h.doc_id = f.doc_id AND h.j = r.j LEFT JOIN len l ON l.doc_id = f.doc_id),
vec AS (SELECT doc_id, list_append(list(v ORDER BY j), 1.0::DOUBLE) AS x FROM cell GROUP BY doc_id),
data AS (SELECT x, label FROM vec JOIN lab USING (doc_id) WHERE train),
cells AS (SELECT c, j FROM (SELECT unnest(range(0, 3)) AS c) CROSS JOIN (SELECT unnest(range(1, {_K + 2})) AS j)),
it AS (
  SELECT 0 AS k, list_transform(range({3 * (_K + 1)}), lambda i: 0.0::DOUBLE) AS w, list_transform(range({3 * (_K + 1)}), lambda i: 0.0::DOUBLE) AS v
  UNION ALL
  SELECT k + 1, list(wn ORDER BY pos), list(wn + {BETA!r} * (wn - wo) ORDER BY pos) FROM (
    SELECT k, pos, vo - (g + {TW.RIDGE} * vo) / {BIG!r} AS wn, wo FROM (
      SELECT k, c * {_K + 1} + j AS pos, any_value(v[c * {_K + 1} + j]) AS vo, any_value(w[c * {_K + 1} + j]) AS wo,
             avg((p[c + 1] - CASE WHEN label = c THEN 1.0::DOUBLE ELSE 0 END) * x[j]) AS g
      FROM (SELECT k, w, v, x, label, list_transform(e, lambda y: y / list_sum(e)) AS p FROM (
              SELECT k, w, v, x, label, list_transform(z, lambda y: exp(y - list_max(z))) AS e FROM (
                SELECT k, w, v, x, label, [list_dot_product(x, v[1:{_K + 1}]), list_dot_product(x, v[{_K + 2}:{2 * _K + 2}]), list_dot_product(x, v[{2 * _K + 3}:{3 * _K + 3}])] AS z
                FROM it CROSS JOIN data WHERE k < {_STEPS})))
      CROSS JOIN cells GROUP BY k, c, j))
  GROUP BY k),
fin AS (SELECT w FROM it WHERE k = {_STEPS}),
zed AS (SELECT doc_id, [list_dot_product(x, w[1:{_K + 1}]), list_dot_product(x, w[{_K + 2}:{2 * _K + 2}]), list_dot_product(x, w[{2 * _K + 3}:{3 * _K + 3}])] AS z
        FROM vec CROSS JOIN fin),
prob AS (SELECT doc_id, z, list_transform(z, lambda y: exp(y - list_max(z)) / (exp(z[1] - list_max(z)) + exp(z[2] - list_max(z)) + exp(z[3] - list_max(z)))) AS p FROM zed),
scored AS (SELECT doc_id, cast(list_position(z, list_max(z)) - 1 AS INTEGER) AS prediction,
             ['Negative', 'Positive', 'Neutral'][list_position(z, list_max(z))] AS predicted,
             round(p[1], 4) AS p_0, round(p[2], 4) AS p_1, round(p[3], 4) AS p_2 FROM prob)
"""


def trained(spark, d):
    """The weight table of the training part; every call fits its own."""
    data = TM.key_split(labeled_documents(spark, d), "doc_id")
    return TW.train(data.filter(F.col("split") == "train"))


def test_part(spark, d):
    return TM.key_split(labeled_documents(spark, d), "doc_id").filter(F.col("split") == "test")


def spelled(scored):
    """One column per probability, rounded."""
    rest = [c for c in scored.columns if c != "p"]
    return rounded(scored.select(*rest, *[F.col("p")[c].alias(f"p_{c}") for c in range(TW.CLASSES)]), 4)


@register("sentiment_predictions", _MODEL_SQL + """
SELECT doc_id, label, prediction, predicted, p_0, p_1, p_2 FROM scored JOIN lab USING (doc_id) WHERE NOT train""")
def q_sentiment_predictions(spark, d):
    return spelled(TW.score_by_terms(trained(spark, d), test_part(spark, d), keep=["doc_id", "label"]))


@register("confusion_matrix", _MODEL_SQL + """
SELECT label, prediction, count(*) AS n FROM scored JOIN lab USING (doc_id) WHERE NOT train GROUP BY label, prediction""")
def q_confusion_matrix(spark, d):
    """Label by prediction; cells without documents have no row."""
    return TM.confusion(TW.score_by_terms(trained(spark, d), test_part(spark, d), keep=["doc_id", "label"]))


@register("score_documents", _MODEL_SQL + "SELECT doc_id, prediction, predicted, p_0, p_1, p_2 FROM scored")
def q_score_documents(spark, d):
    docs = X.table(spark, d, "documents").select("doc_id", "text")
    return spelled(TW.score_by_terms(trained(spark, d), docs))


@register("model_weights", _MODEL_SQL + f"""
SELECT term, round(idf, 9) AS idf, cast(c AS INTEGER) AS class, round(w[c * {_K + 1} + j], 4) AS weight FROM terms CROSS JOIN (SELECT unnest(range(0, 3)) AS c) CROSS JOIN fin
UNION ALL SELECT NULL, NULL, cast(c AS INTEGER), round(w[c * {_K + 1} + {_K + 1}], 4) FROM (SELECT unnest(range(0, 3)) AS c) CROSS JOIN fin""")
def q_model_weights(spark, d):
    """The exported model: one row per term and class, and the constant's."""
    return rounded(rounded(trained(spark, d), 4, ["weight"]), 9, ["idf"])
