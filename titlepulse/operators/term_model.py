"""A class model as a table: (term, idf, class, weight).

Features are the L2-normalised TF-IDF weights of the terms whose document
shares differ most between the classes, and a constant. The model is
multinomial logistic regression with a ridge on every weight, so its optimum
is unique, and it is solved by Newton steps until the gradient vanishes: any
right solver gives the same numbers. A step is one aggregate over the rows; the
driver holds the terms' weights and their Hessian, whose size is the chosen
number of terms and classes.

Documents are scored without a model object, in batch or in the micro-batches
of a stream: tokens join the table on the term, products are summed per
document and class, and a softmax gives probabilities.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, IDFModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titlepulse.functions.labels import label_name
from titlepulse.operators.partitioning import cut_lineage
from titlepulse.operators.text_model import tokens

CLASSES = 3
TERMS = 24
RIDGE = 0.02
TOLERANCE = 1e-13
MAX_STEPS = 60
WEIGHTS = "term string, idf double, class int, weight double"


def class_terms(tok: DataFrame, k: int = TERMS, label: str = "label", filtered: str = "filtered",
                classes: int = CLASSES) -> DataFrame:
    """(term, idx, idf) of the k terms with the largest difference between the
    classes' shares of documents that hold them; ties by term."""
    in_class = [F.col(label) == c for c in range(classes)]
    docs = tok.agg(F.struct(F.count(F.lit(1)).alias("n"), *[F.sum(F.when(w, 1).otherwise(0)).alias(f"c{i}") for i, w in enumerate(in_class)])).scalar()
    seen = tok.select(label, F.explode(F.array_distinct(filtered)).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), *[F.sum(F.when(w, 1).otherwise(0)).alias(f"n{i}") for i, w in enumerate(in_class)])
    share = [F.coalesce(F.try_divide(F.col(f"n{i}").cast("double"), docs.getField(f"c{i}").cast("double")), F.lit(0.0)) for i in range(classes)]
    spread = F.greatest(*share) - F.least(*share)
    idf = F.log((docs.getField("n") + 1).cast("double") / (F.col("df") + 1))
    best = seen.select("term", idf.alias("idf"), spread.alias("spread")).orderBy(F.desc("spread"), "term").limit(k)
    # Numbers for k rows, whatever the corpus holds.
    idx = F.row_number().over(Window.orderBy(F.desc("spread"), "term")) - 1
    return cut_lineage(best.select("term", idx.alias("idx"), "idf"), "class_terms")


def vectors(tok: DataFrame, terms: DataFrame, k: int = TERMS, doc: str = "doc_id", label: str = "label",
            filtered: str = "filtered") -> DataFrame:
    """(doc, label, x): the unit vector of a document's TF-IDF weights, then 1."""
    hits = tok.select(doc, F.explode(filtered).alias("term")).join(terms, "term") \
        .groupBy(doc, "idx").agg((F.count(F.lit(1)) * F.first("idf")).alias("v"))
    own = hits.groupBy(F.col(doc).alias("_d")).agg(F.map_from_entries(F.collect_list(F.struct("idx", "v"))).alias("m"))
    raw = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0)))
    full = tok.select(doc, label).join(own, F.col(doc) == F.col("_d"), "left").select(doc, label, raw.alias("x"))
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v))
    return full.withColumn("norm", norm).select(doc, label, F.array_append(F.transform("x", lambda v: F.when(F.col("norm") > 0, v / F.col("norm")).otherwise(v)),
                                                                           F.lit(1.0)).alias("x"))


def softmax(z: Column) -> Column:
    e = F.transform(z, lambda v: F.exp(v - F.array_max(z)))
    return F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def _dot(x: Column, w: np.ndarray) -> Column:
    pairs = F.zip_with(x, F.array(*[F.lit(float(v)) for v in w]), lambda a, b: a * b)
    return F.aggregate(pairs, F.lit(0.0), lambda a, b: a + b)


def _sums(data: DataFrame, w: np.ndarray, label: str) -> tuple[float, np.ndarray, np.ndarray, float]:
    """Log loss, gradient, Hessian and row count: one aggregate over the rows."""
    c, k = w.shape
    z = data.select(label, "x", F.array(*[_dot(F.col("x"), row) for row in w]).alias("z"))
    p = z.select(label, "x", "z", softmax(F.col("z")).alias("p"))
    miss = [F.col("p")[i] - F.when(F.col(label) == i, 1.0).otherwise(0.0) for i in range(c)]
    scaled = lambda s: F.transform("x", lambda v: v * s)
    outer = lambda s: F.flatten(F.transform("x", lambda a: F.transform("x", lambda b: a * b * s)))
    pair = [(i, j) for i in range(c) for j in range(i, c)]
    curve = [outer(F.col("p")[i] * ((1.0 if i == j else 0.0) - F.col("p")[j])) for i, j in pair]
    top = F.array_max("z")
    loss = F.log(F.aggregate("z", F.lit(0.0), lambda a, v: a + F.exp(v - top))) + top - F.element_at("z", F.col(label) + 1)
    each = p.select(array_to_vector(F.concat(F.array(loss, F.lit(1.0)), *[scaled(m) for m in miss], *curve)).alias("v"))
    got = each.select(Summarizer.sum(F.col("v")).alias("s")).first()["s"]
    s = got.toArray()
    hess = np.zeros((c, k, c, k))
    for n, (i, j) in enumerate(pair):
        block = s[2 + c * k + n * k * k: 2 + c * k + (n + 1) * k * k].reshape(k, k)
        hess[i, :, j, :] = block
        hess[j, :, i, :] = block
    return s[0], s[2: 2 + c * k].reshape(c, k), hess.reshape(c * k, c * k), s[1]


def fit_ridge(data: DataFrame, width: int, label: str = "label", ridge: float = RIDGE, classes: int = CLASSES,
              tolerance: float = TOLERANCE, max_steps: int = MAX_STEPS) -> np.ndarray:
    """Weights (class, feature) that minimise mean log loss + ridge / 2 * |W|^2
    over data(label, x): Newton steps, each halved until the loss falls. No
    rows give weights of zero; more than ``max_steps`` raise."""
    w = np.zeros((classes, width))
    if data.isEmpty():
        return w
    flat = lambda a: a.ravel()
    best = None
    for _ in range(max_steps):
        loss, grad, hess, n = _sums(data, w, label)
        value = loss / n + ridge / 2 * float((w ** 2).sum())
        g = flat(grad) / n + ridge * flat(w)
        if np.abs(g).max() < tolerance:
            return w
        if best is not None and value > best[0] + 1e-12:
            w = (w + best[1]) / 2  # too long a step: half of it
            continue
        if best is not None and np.abs(g).max() >= best[2] and np.abs(g).max() < 1e-11:
            return w  # as near as the sums' rounding allows
        best = (value, w, np.abs(g).max())
        w = w - np.linalg.solve(hess / n + ridge * np.eye(len(g)), g).reshape(w.shape)
    raise RuntimeError(f"no convergence in {max_steps} steps")


def train(docs: DataFrame, k: int = TERMS, label: str = "label", text: str = "text", doc: str = "doc_id",
          ridge: float = RIDGE, classes: int = CLASSES) -> DataFrame:
    """The weight table of docs(doc_id, text, label); the constant's rows have
    no term. Rows whose label is null or none of the classes are left out."""
    known = docs.filter(F.col(label).isin(*range(classes)))
    tok = cut_lineage(tokens(known.select(doc, label, text), text).select(doc, label, "filtered"), "train_tokens")
    terms = class_terms(tok, k, label, classes=classes)
    data = cut_lineage(vectors(tok, terms, k, doc, label), "train_vectors")
    w = fit_ridge(data, k + 1, label, ridge, classes)
    spark = docs.sparkSession
    values = spark.createDataFrame([(j, c, float(w[c, j])) for c in range(classes) for j in range(k + 1)], "idx int, class int, weight double")
    by_term = values.join(terms, "idx").select("term", "idf", "class", "weight")
    const = values.filter(F.col("idx") == k).select(F.lit(None).cast("string").alias("term"), F.lit(None).cast("double").alias("idf"), "class", "weight")
    return cut_lineage(by_term.unionByName(const), "weights")


def pipeline_weights(model: PipelineModel) -> DataFrame:
    """The weight table of a fitted pipeline whose counts have a vocabulary;
    score it with ``unit=False``. The table is as large as the vocabulary."""
    counts = next(s for s in model.stages if isinstance(s, CountVectorizerModel))
    idf = next(s for s in model.stages if isinstance(s, IDFModel)).idf.toArray()
    lr = next(s for s in model.stages if isinstance(s, LogisticRegressionModel))
    coef, const = lr.coefficientMatrix.toArray(), lr.interceptVector.toArray()
    if len(coef) == 1:  # two classes: the first one is the baseline
        coef, const = np.vstack([np.zeros_like(coef[0]), coef[0]]), np.array([0.0, const[0]])
    from pyspark.sql import SparkSession

    rows = [(t, float(idf[j]), c, float(coef[c, j])) for j, t in enumerate(counts.vocabulary) for c in range(len(coef))]
    return SparkSession.active().createDataFrame(rows + [(None, None, c, float(v)) for c, v in enumerate(const)], WEIGHTS)


def score_by_terms(weights: DataFrame, docs: DataFrame, text: str = "text", doc: str = "doc_id", keep: list[str] | None = None,
                   classes: int = CLASSES, unit: bool = True) -> DataFrame:
    """prediction, its name, and the probabilities p (array) of every document;
    ``unit`` scales a document's TF-IDF weights to length 1. ``doc`` is a key:
    rows that share it are one document. Ties go to the lower class; a null
    text is empty and gets the constant's probabilities."""
    keep = keep if keep is not None else [c for c in docs.columns if c != text]
    by_term = weights.filter("term is not null").groupBy("term", "idf").agg(F.map_from_entries(F.collect_list(F.struct("class", "weight"))).alias("w"))
    const = weights.filter("term is null").agg(F.map_from_entries(F.collect_list(F.struct("class", "weight"))).alias("w")).scalar()
    hits = (tokens(docs.select(doc, text), text).select(doc, F.explode("filtered").alias("term")).join(by_term, "term")
            .groupBy(doc, "term").agg((F.count(F.lit(1)) * F.first("idf")).alias("v"), F.first("w").alias("w")))
    sums = [F.sum(F.col("v") * F.col("w")[c]).alias(f"z{c}") for c in range(classes)]
    got = hits.groupBy(F.col(doc).alias("_d")).agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"), *sums)
    scale = F.when(F.col("norm") > 0, F.col("norm")).otherwise(1.0) if unit else F.lit(1.0)
    z = F.array(*[F.coalesce(F.col(f"z{c}") / scale, F.lit(0.0)) + const[c] for c in range(classes)])
    out = docs.select(*keep, F.col(doc).alias("_k")).join(got, F.col("_k") == F.col("_d"), "left").select(*keep, z.alias("z"))
    at = (F.array_position("z", F.array_max("z")) - 1).cast("int")
    return out.select(*keep, at.alias("prediction"), label_name(at).alias("predicted"), softmax(F.col("z")).alias("p"))
