"""Empirical Bayes posteriors recomputed with plain Python from the log-odds."""

import math
import random
from collections import defaultdict

import pytest

from titlepulse.llm import site_quality as S
from titlepulse.llm.linear import fit, with_scores

ROWS = 150


def strength(mean, shares, noises):
    m = sum(shares) / len(shares)
    return beta(mean, sum((x - m) ** 2 for x in shares) / len(shares), sum(noises) / len(noises))


def beta(mean, spread, noise):
    between = spread - noise
    return 1e4 if between <= 0 else min(1e4, max(2.0, mean * (1 - mean) / between - 1))


def brute(docs, z, share):
    """Per document the posterior, host share and path share of one head."""
    p = [1 / (1 + math.exp(-x)) for x in z]
    hosts, paths = defaultdict(list), defaultdict(list)
    for (_, _, lang, source), x in zip(docs, p, strict=True):
        hosts[source or ""].append(x)
        paths[source or "", lang or ""].append(x)
    mean = sum(p) / len(p)
    noise = lambda xs: sum(x * (1 - x) for x in xs) / len(xs) ** 2
    kappa = strength(mean, [sum(x) / len(x) for x in hosts.values()], [noise(x) for x in hosts.values()])
    host = {h: (kappa * mean + sum(x)) / (kappa + len(x)) for h, x in hosts.items()}
    depth = beta(mean, sum((sum(x) / len(x) - host[k[0]]) ** 2 for k, x in paths.items()) / len(paths),
                 sum(noise(x) for x in paths.values()) / len(paths))
    out = []
    for (_, _, lang, source), x, odds in zip(docs, p, z, strict=True):
        h, group = host[source or ""], paths[source or "", lang or ""]
        path = (depth * h + sum(group) - x) / (depth + len(group) - 1)
        q = min(1 - 1e-6, max(1e-6, path))
        out.append((1 / (1 + math.exp(-(math.log(q / (1 - q)) + odds - math.log(share / (1 - share))))), h, path))
    return out


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(4)
    docs, labels = [], []
    for i in range(400):
        source = "hot" if i % 3 == 0 else rnd.choice(["s1", "s2", "s3", None, f"lone{i}"])
        bad = rnd.random() < {"s1": 0.7, "hot": 0.1}.get(source, 0.3)
        toxic = rnd.random() < (0.4 if source == "s2" else 0.1)
        words = [f"wo{rnd.randrange(90)}" + ("$$" if bad else "") for _ in range(rnd.randrange(5, 40))] + ["idiot"] * 2 * toxic
        docs.append((i, " ".join(words) if i % 50 else rnd.choice([None, ""]), rnd.choice(["en", "fr", None]), source))
        labels.append((i, int(not bad), int(toxic)))
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_posteriors_equal_plain_python(spark, table):
    df, labels = table
    got = {r.doc_id: r for r in S.site_quality(df, labels, fit_rows=ROWS).collect()}
    weights, bias, share = fit(S.labelled_rows(df, S.sample_labels(labels, ROWS)), 2, ROWS, fetch=3 * ROWS)
    scored = sorted(with_scores(df, weights, bias, "z", "n").collect(), key=lambda r: r.doc_id)
    docs = [(r.doc_id, r.text, r.lang, r.source) for r in scored]
    want = [brute(docs, [r.z[k] for r in scored], float(share[k])) for k in range(2)]
    for i, (q, t) in enumerate(zip(*want, strict=True)):
        r = got[docs[i][0]]
        assert (r.quality, r.host_quality, r.path_quality) == pytest.approx(q, abs=1e-7)
        assert (r.toxic, r.host_toxic, r.path_toxic) == pytest.approx(t, abs=1e-7)
        assert r.keep == (q[0] >= 0.5 and t[0] < 0.5)
    assert len(got) == 400 and len({round(w[1], 9) for w in want[0]}) > 5  # hosts differ


def test_sites_with_equal_shares_lean_wholly_on_their_parents(spark):
    """Ties: the spread between sites is below their noise, so the prior has its greatest strength."""
    assert S._strength(0.4, 0.01, 0.01) == S._strength(0.4, None, None) == 1e4
    assert S._strength(0.5, 0.25, 0.0) == 2.0
