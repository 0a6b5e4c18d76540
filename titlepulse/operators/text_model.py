"""Tokens, term statistics and the TF-IDF + logistic-regression sentiment model.

Term statistics (term frequency, document frequency, IDF) are plain
aggregates over exploded tokens, two partial-aggregated group-bys, no
per-document Python. The model is Spark ML's own pipeline: Tokenizer ->
StopWordsRemover -> CountVectorizer -> IDF -> LogisticRegression, whose fit is
distributed (vocabulary by a reduce capped at ``vocab_size``, IDF by one
aggregate, L-BFGS by tree aggregation).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizer, HashingTF, StopWordsRemover, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlepulse.functions.labels import label_name
from titlepulse.functions.text import ENGLISH_STOP_WORDS
from titlepulse.session import scratch_path

# Parameters of the original model stages and the columns of a saved model.
VOCAB_SIZE = 262144
# Width of the hashed features: no term is dropped, equal hashes share a weight.
HASHED = 1 << 18
MIN_DF = 1.0
MIN_TF = 1.0
MIN_DOC_FREQ = 0
LR_MAX_ITER = 100
LR_REG = 0.0
LR_TOL = 1e-6
TRAIN_PERCENT = 80


# The characters Java's \\s matches (the Tokenizer's separator).
WHITESPACE = " \t\n\x0b\x0c\r"
WHITESPACE_CLASS = "[ \\t\\n\\x0B\\f\\r]"


def tokenize(text) -> Column:
    """Spark ML ``Tokenizer`` semantics with built-in functions: lower-case,
    split on single whitespace characters, leading and inner empty tokens
    kept, trailing empty tokens dropped (Java ``String.split``), so an
    all-whitespace text gives no tokens and an empty text one empty token.
    Built-ins stay in whole-stage codegen; the ML transformer is a UDF and
    about twice as slow once exploded."""
    s = F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))
    trimmed = F.rtrim(s, F.lit(WHITESPACE))
    return (F.when((F.length(s) > 0) & (trimmed == ""), F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, WHITESPACE_CLASS)))


def remove_stop_words(words, stop: list[str] = ENGLISH_STOP_WORDS) -> Column:
    """``StopWordsRemover`` (case-insensitive) on already lower-cased tokens."""
    w = F.col(words) if isinstance(words, str) else words
    return F.filter(w, lambda x: ~x.isin(stop))


def tokens(df: DataFrame, text: str = "text", words: str = "words",
           filtered: str = "filtered") -> DataFrame:
    """Adds ``words`` (Tokenizer) and ``filtered`` (stop words removed)."""
    out = df.withColumn(words, tokenize(text))
    return out.withColumn(filtered, remove_stop_words(words))


def term_stats(tok: DataFrame, doc: str = "doc_id", filtered: str = "filtered") -> DataFrame:
    """(term, tf, df): total count and number of documents containing the term."""
    # Every occurrence counts (1, 0) and every distinct term of a document (0, 1),
    # so one aggregate, combined map-side to a row per term and task, gives both.
    each = F.transform(F.col(filtered), lambda t: F.struct(t.alias("term"), F.lit(1).alias("tf"), F.lit(0).alias("df")))
    once = F.transform(F.array_distinct(filtered), lambda t: F.struct(t.alias("term"), F.lit(0).alias("tf"), F.lit(1).alias("df")))
    return (tok.select(F.explode(F.concat(each, once)).alias("x")).groupBy(F.col("x.term").alias("term"))
            .agg(F.sum("x.tf").alias("tf"), F.sum("x.df").alias("df")))


def doc_terms(tok: DataFrame, doc: str = "doc_id", filtered: str = "filtered") -> DataFrame:
    """(doc, term, tf): the count vector of each document, as rows."""
    return tok.select(doc, F.explode(filtered).alias("term")).groupBy(doc, "term").agg(F.count(F.lit(1)).alias("tf"))


def doc_tfidf(tok: DataFrame, n_docs, doc: str = "doc_id", filtered: str = "filtered") -> DataFrame:
    """(doc, term, tf, tfidf): count times the term's IDF over all documents.

    Of the statistics only the document frequency is wanted; the weights, a
    row per term, are hashed by the partition, so that the counts need no sort."""
    once = tok.select(F.explode(F.array_distinct(filtered)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weights = idf_weights(once, n_docs).select("term", "idf")
    return doc_terms(tok, doc, filtered).join(weights.hint("shuffle_hash"), "term").select(doc, "term", "tf", (F.col("tf") * F.col("idf")).alias("tfidf"))


def idf_weights(stats: DataFrame, n_docs) -> DataFrame:
    """IDF as Spark ML computes it: ln((N + 1) / (df + 1)); ``n_docs`` is a
    number or a scalar column."""
    n = F.lit(float(n_docs + 1)) if isinstance(n_docs, int) else (n_docs + 1).cast("double")
    return stats.select("term", "df", F.log(n / (F.col("df") + 1)).alias("idf"))


def hash_bucket(key, buckets: int = 100) -> Column:
    """A stable bucket in [0, buckets) from the md5 of the key."""
    k = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint") % buckets


def key_split(df: DataFrame, key: str, train_percent: int = TRAIN_PERCENT) -> DataFrame:
    """Adds ``split`` = train / test by a hash of the key, so a split repeats
    whatever the partitioning (``randomSplit`` does not)."""
    return df.withColumn("split", F.when(hash_bucket(key) < train_percent, "train").otherwise("test"))


def dropped_terms(stats: DataFrame, vocab_size: int = VOCAB_SIZE) -> int:
    """How many terms of ``term_stats`` a vocabulary of that size leaves out."""
    return max(0, stats.count() - vocab_size)


def sentiment_pipeline(text: str = "text", label: str = "label", vocab_size: int | None = None,
                       max_iter: int = LR_MAX_ITER, hashed: int = HASHED) -> Pipeline:
    """Tokens, term counts, IDF, logistic regression. Counts are hashed into
    ``hashed`` columns, so no term is dropped and no vocabulary comes to the
    driver; ``vocab_size`` asks for the original's vocabulary of the most
    frequent terms instead (see ``dropped_terms``)."""
    counts = (HashingTF(inputCol="filtered", outputCol="raw_features", numFeatures=hashed) if vocab_size is None else
              CountVectorizer(inputCol="filtered", outputCol="raw_features", vocabSize=vocab_size, minDF=MIN_DF, minTF=MIN_TF))
    return Pipeline(stages=[
        Tokenizer(inputCol=text, outputCol="words"),
        StopWordsRemover(inputCol="words", outputCol="filtered", stopWords=ENGLISH_STOP_WORDS),
        counts,
        IDF(inputCol="raw_features", outputCol="features", minDocFreq=MIN_DOC_FREQ),
        LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter,
                           regParam=LR_REG, tol=LR_TOL),
    ])


def fit(train: DataFrame, text: str = "text", label: str = "label", **kw) -> PipelineModel:
    staged = train.withColumn(text, F.coalesce(F.col(text), F.lit("")))
    model = sentiment_pipeline(text, label, **kw).fit(staged)
    # A fresh model holds its training summary and with it the session, which
    # cannot be sent to tasks once the session has observed metrics; the saved
    # model holds its coefficients alone.
    path = scratch_path(train.sparkSession, "text_model")
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def score(model: PipelineModel, df: DataFrame, text: str = "text",
          keep: list[str] | None = None) -> DataFrame:
    """prediction, its name and its probability for every row (batch or stream)."""
    staged = df.withColumn(text, F.coalesce(F.col(text), F.lit("")))
    out = model.transform(staged)
    keep = keep if keep is not None else [c for c in df.columns if c != text]
    prob = vector_to_array("probability")
    return out.select(*keep, F.col("prediction").cast("int").alias("prediction"),
                      label_name("prediction").alias("predicted"),
                      F.array_max(prob).alias("p_max"),
                      F.aggregate(prob, F.lit(0.0), lambda a, x: a + x).alias("p_sum"))


def audited(model: PipelineModel, df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """What can be said of any right scoring without the model: the class is
    one of the three, is the most probable one, and probabilities sum to 1."""
    out = model.transform(df.withColumn(text, F.coalesce(F.col(text), F.lit(""))))
    keep = keep if keep is not None else [c for c in df.columns if c != text]
    prob, at = vector_to_array("probability"), F.col("prediction").cast("int")
    return out.select(*keep, at.isin(0, 1, 2).alias("is_class"), (F.element_at(prob, at + 1) == F.array_max(prob)).alias("is_argmax"),
                      F.aggregate(prob, F.lit(0.0), lambda a, x: a + x).alias("p_sum"))


def confusion(scored: DataFrame, label: str = "label") -> DataFrame:
    return scored.groupBy(F.col(label).cast("int").alias("label"), "prediction").agg(
        F.count(F.lit(1)).alias("n"))


def accuracy(scored: DataFrame, label: str = "label") -> DataFrame:
    """Share of rows whose prediction equals the label, and the row count."""
    hit = (F.col(label).cast("int") == F.col("prediction")).cast("double")
    return scored.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))
