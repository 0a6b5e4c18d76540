"""The corpus pipeline and the registered queries."""
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline as P
from titlepulse.llm import queries
from titlepulse.llm.site_quality import site_quality
from titlepulse.llm.token_shards import tokenizer_path

NATIVE = ("op4_url_rules", "op7_block_naming", "op8_license_scan", "op10_decontamination")


def test_every_operator_is_registered_once():
    names = [n for n in E.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries() and 4 <= len(P.STAGES) <= 5
    assert set(queries.ORACLE) <= set(queries.QUERIES)


def kept_by_brute_force(texts):
    """Places of the texts that are the first of those they link to."""
    sets = []
    for t in texts:
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    comp, holders = list(range(len(sets))), {}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i, s in enumerate(sets):
        for j in sorted({j for x in s for j in holders.get(x, ())}):
            both = len(s & sets[j])
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                comp[max(a, b)] = min(a, b)
        for x in s:
            holders.setdefault(x, []).append(i)
    return [i for i in range(len(sets)) if find(i) == i]


def contaminated(text, benchmark):
    """13-word windows of the benchmark, looked for in a text word by word."""
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    windows = set()
    for item in benchmark:
        w = words(item)
        windows |= {tuple(w[i:i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
    w, hit = words(text), set()
    for size in {len(x) for x in windows}:
        for i in range(len(w) - size + 1):
            if tuple(w[i:i + size]) in windows:
                hit.update(range(i, i + size))
    return bool(hit) and 20 * len(hit) >= len(w)


@pytest.fixture(scope="module")
def written(spark, sf, tmp_path_factory):
    """The documents and each stage's rows, each written and read again."""
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    out.append(docs)
    for k, (_, stage) in enumerate(P.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, out[-1], sf).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def in_order(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0))


def test_stages_keep_the_columns_and_take_effect(written):
    counts = [df.count() for df in written]
    for (name, _), df in zip(P.STAGES[:-1], written[1:-1], strict=True):
        assert df.columns == written[0].columns, name
    assert counts[0] > counts[1] > counts[2] >= counts[3] and counts[4] == counts[5] > 0


def test_quality_stage_keeps_what_the_operator_keeps(spark, sf, written):
    judged = site_quality(written[0], spark.read.parquet(f"{sf}/labels.parquet"))
    keep = {r.doc_id for r in judged.filter("keep").collect()}
    assert in_order(written[1]) == [r for r in in_order(written[0]) if r[0] in keep]


def test_join_stage_by_brute_force(written):
    before = in_order(written[1])
    assert in_order(written[2]) == [before[i] for i in kept_by_brute_force([r[1] for r in before])]


def test_decontamination_stage_by_brute_force(spark, sf, written):
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    before = in_order(written[2])
    assert in_order(written[3]) == [r for r in before if not contaminated(r[1], items)]
    # the stage's rule on every document, those that other stages drop too
    everyone = in_order(written[0])
    kept = in_order(P.benchmark_decontamination(spark, written[0], sf))
    assert kept == [r for r in everyone if not contaminated(r[1], items)] and len(kept) < len(everyone)


def test_mixing_stage_gives_each_row_as_often_as_its_rate(spark, sf, written):
    before, copies = in_order(written[3]), Counter(in_order(written[4]))
    assert set(copies) <= set(before)
    mixed = queries.soft_mixing(written[3], queries.labelled_domains(written[3], spark.read.parquet(f"{sf}/labels.parquet")), queries.TARGETS)
    rates = {r.doc_id: r.rate for r in mixed.collect()}
    for r in before:
        assert int(rates[r[0]]) <= copies[r] <= int(rates[r[0]]) + 1


def test_token_stage_equals_the_library(written):
    tok = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    texts = [(r[0], r[1]) for r in in_order(written[4])]
    start, want = 0, []
    for doc, text in texts:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((doc, start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((tuple(r) for r in written[5].collect()), key=lambda r: r[1]) == want


def test_run_equals_the_stages(spark, sf, written):
    got = P.run(spark, sf)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, written[5].collect()))


def test_join_stage_links_at_80_percent_of_5_word_shingles(spark):
    rnd = random.Random(9)
    vocab = [f"v{i}" for i in range(500)]
    texts = []
    for k in range(30):
        base = [rnd.choice(vocab) for _ in range(100)]
        # k % 3 scattered edits more than one: two edits leave 0.811 by 5-word shingles, 0.848 by 4-word ones.
        edited = [w if i not in range(20, 20 + 30 * (k % 3 + 1), 30) else "edit" + w for i, w in enumerate(base)]
        texts += [" ".join(base), " ".join(edited)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = sorted(r.doc_id for r in P.ngram_jaccard_join(spark, docs, "").collect())
    assert got == kept_by_brute_force(texts) and len(got) == 40


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_have_no_python(spark, sf, name):
    df = queries.QUERIES[name](spark, sf)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin") if x in plan]
