"""The ten operators on small tables: brute force, and odd input."""
import hashlib
import random
import re
import zlib
from itertools import combinations

import numpy as np
import pytest

from titlepulse.llm import decontaminate as dec
from titlepulse.llm import license_scan, mixing, token_shards, url_rules, warc_merkle
from titlepulse.llm.exact_dedup import exact_dedup
from titlepulse.llm.graph import components
from titlepulse.llm.ngram_join import jaccard_components, one_of_each
from titlepulse.llm.site_quality import keep_good, site_quality
from titlepulse.llm.suffix_dedup import remove_repeats

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30000))


def frame(spark, texts, ids=None, extra=""):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", f"s{k % 3}", len(t or "")) + ((1, "z", True) if extra else ()) for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, DOCS + extra)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows and
    ids, and further columns with clashing names."""
    texts = [None, "", "  ", "one two three four five", "one two  three\nfour five", LONG, LONG, LONG + " end", "short", "short"]
    df = frame(spark, texts, [1, 2, 3, 4, 5, 6, 7, 8, 9, 9], ", keep int, judgement string, start boolean")
    return df.unionByName(spark.createDataFrame([(None, "no id", None, None, None, None, None, None)], df.schema))


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: tuple((x is not None, x) for x in r))


# ------------------------------------------------------------------ exact dedup

def brute_exact(pairs):
    norm = {}
    for i, t in pairs:
        norm.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    return sorted({(i, min(g), len(g), i == min(g), hashlib.sha256(x.encode()).hexdigest()) for x, g in norm.items() for i in g})


@pytest.mark.parametrize("block,bits", [(4, 64), (2048, 64), (3, 2)])
def test_exact_dedup(spark, block, bits):
    rnd = random.Random(block)
    texts = ["".join(rnd.choice("ab \n") for _ in range(rnd.choice([0, 1, 5, 9, 30]))) for _ in range(60)] + ["é" * 20, "é" * 20, None]
    got = rows(exact_dedup(frame(spark, texts), block, bits), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == brute_exact(list(enumerate(texts)))


def test_exact_dedup_odd(odd):
    got = {r["doc_id"]: r for r in exact_dedup(odd).collect()}
    assert got[1]["keep_id"] == got[2]["keep_id"] == 1 and got[3]["keep_id"] == 3  # white space is one space, not nothing
    assert got[5]["keep_id"] == 4 and got[7]["keep_id"] == 6 and got[8]["keep_id"] == 8
    assert got[9]["group_size"] == 2 and len(got) == 10 and got[None]["keep_id"] is None
    assert exact_dedup(odd.filter("false")).collect() == []


def test_exact_dedup_gives_every_row(spark):
    ids = [3, 3, 3, None, None, 8, 9, 9, None, 12, 12]
    texts = ["a b", "a  b", "c", "c", "x", "x", "y", "y", "z", None, ""]
    got = rows(exact_dedup(frame(spark, texts, ids)), "doc_id", "keep_id", "group_size", "kept")
    want = [(3, 3, 2, True), (3, 3, 2, False), (3, 3, 2, True), (None, 3, 2, False), (None, 8, 2, False), (8, 8, 2, True),
            (9, 9, 2, True), (9, 9, 2, False), (None, None, 1, True), (12, 12, 2, True), (12, 12, 2, False)]
    assert got == sorted(want, key=lambda r: tuple((x is not None, x) for x in r))


# ------------------------------------------------------------------ token shards

def test_token_shards_equal_the_library(spark, odd):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(token_shards.tokenizer_path("word_bpe_49k.json"))
    texts = ["Hello, World!! it's 12 o'clock", "été Àé Σας ΣΑΣ ﬁn", "áb \x1c\x85\xa0z", "<|endoftext|> x<|endoftext|>y", None, "",
             "İstanbul ÇA-VA? naïve... (x) [y] {z}~", "x" * 3000, "日本 語 テスト　空白"]
    for docs, want_rows in ((frame(spark, texts), list(enumerate(texts))), (odd, None)):
        if want_rows is None:
            want_rows = sorted(((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0))
        got = sorted((tuple(r) for r in token_shards.token_shards(docs, shard_tokens=40).collect()), key=lambda r: (r[1], r[0] or 0))
        start = 0
        assert len(got) == len(want_rows)
        for (doc, text), g in zip(want_rows, got):
            ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
            assert g == (doc, start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes()))
            start += len(ids)
    assert token_shards.token_shards(odd.filter("false")).collect() == []


def test_keyed_access(spark, tmp_path):
    path = str(tmp_path / "shards")
    token_shards.write_shards(frame(spark, [f"text {i}" for i in range(50)], range(0, 100, 2)), path, shard_tokens=20)
    got = {r.doc_id: r.ids for r in token_shards.lookup(spark, path, [4, 5, 98, 1000]).collect()}
    assert set(got) == {4, 98} and got[4][-1] == 2 and got[4] != got[98]


# ------------------------------------------------------------------ n-gram join

def brute_sets(text, n=4):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def brute_components(texts):
    sets = [brute_sets(t) for t in texts]
    comp = list(range(len(texts)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                comp[max(a, b)] = min(a, b)
    return [(i, len(s), find(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("block", [4, 512])
def test_ngram_join(spark, block):
    rnd = random.Random(7)
    vocab = [f"v{i}" for i in range(400)]
    texts = []
    for _ in range(8):
        base = [rnd.choice(vocab) for _ in range(rnd.choice([60, 120]))]
        for _ in range(7):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            texts.append(" ".join(w))
    line = " ".join(vocab[:30])
    texts += [line + " " + " ".join(rnd.choice(vocab) for _ in range(6)) for _ in range(25)]  # a shared passage
    texts += ["a b", "A  b", "a b c", "", None, " . "]
    got = rows(jaccard_components(frame(spark, texts), block=block), "doc_id", "n_shingles", "component_id")
    want = brute_components(texts)
    assert got == want and len({c for _, _, c in want}) < len(want) - 20


def test_ngram_join_odd(spark, odd):
    got = {r["doc_id"]: r for r in jaccard_components(odd).collect()}
    assert jaccard_components(odd).count() == 11 and got[1]["n_shingles"] == 0 and got[9]["component_id"] == 9 and got[2]["component_id"] == 2
    assert got[5]["component_id"] == 4 and got[8]["component_id"] == 6 and got[None]["component_id"] is None
    kept = one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 9]
    assert jaccard_components(odd.filter("false")).collect() == []


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(20, 60)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 20 for i in range(20, 61)) and all(got[100 + i] == 100 for i in range(30)) and 7 not in got


# ------------------------------------------------------------------ suffix dedup

def brute_repeats(texts, width):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for k, b in enumerate(raw):
        for i in range(len(b) - width + 1):
            seen.setdefault(b[i:i + width], []).append((k, i))
    cover = [bytearray(len(b)) for b in raw]
    for places in seen.values():
        if len(places) > 1:
            for k, i in places:
                cover[k][i:i + width] = b"\1" * width
    out = []
    for k, (b, c) in enumerate(zip(raw, cover)):
        kept = bytes(x for x, y in zip(b, c) if not y)
        spans = sum(1 for i in range(len(b)) if c[i] and not (i and c[i - 1]))
        out.append((k, len(b), sum(c), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_dedup(spark):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(1, 7)))
    para = [" ".join(word() for _ in range(25)) for _ in range(12)]
    texts = [" ".join([*(word() for _ in range(rnd.randrange(12))), rnd.choice(para), *(word() for _ in range(rnd.randrange(9))),
                       rnd.choice(para)[rnd.randrange(30):]]) for _ in range(40)]
    texts += ["ab" * 60, "x" * 100, "", None, para[0], para[0], "é" * 39]
    got = rows(remove_repeats(frame(spark, texts), 40, 16), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute_repeats(texts, 40)


def test_suffix_dedup_odd(odd):
    got = {r["doc_id"]: r for r in remove_repeats(odd, texts=True).collect()}
    assert set(got) == {None, *range(1, 10)} and remove_repeats(odd).count() == 11 and got[1]["n_bytes"] == 0
    assert got[6]["n_removed"] == got[6]["n_bytes"] and got[9]["n_removed"] == 0 and got[None]["n_bytes"] == 5
    assert got[8]["n_bytes"] - got[8]["n_removed"] <= 4 and bytes(got[4]["kept"]) == b"one two three four five"
    assert remove_repeats(odd.filter("false")).collect() == []


# ------------------------------------------------------------------ every row

def any_ids(n):
    """Ids that stand once, repeat, or are missing."""
    return [None if k % 5 == 0 else 7 if k % 5 == 1 else 100 + k for k in range(n)]


def some_texts(rnd, words=40):
    base = [" ".join(f"w{rnd.randrange(50)}" for _ in range(words)) for _ in range(6)]
    return [rnd.choice(base) + rnd.choice(["", "", " tail", " other tail here"]) for _ in range(40)] + [None, "", "alone"]


def test_every_row_is_compared_by_suffixes(spark):
    texts = some_texts(random.Random(21))
    ids = any_ids(len(texts))
    got = sorted(rows(remove_repeats(frame(spark, texts, ids), 40, 16), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"), key=repr)
    assert got == sorted(((ids[r[0]], *r[1:]) for r in brute_repeats(texts, 40)), key=repr)


def test_every_row_is_joined(spark):
    texts = some_texts(random.Random(22), 120)
    ids = any_ids(len(texts))
    comps = brute_components(texts)
    low = {}
    for k, _, c in comps:
        low[c] = min((i for i in (low.get(c), ids[k]) if i is not None), default=None)
    got = sorted(rows(jaccard_components(frame(spark, texts, ids)), "doc_id", "n_shingles", "component_id"), key=repr)
    assert got == sorted(((ids[k], n, low[c]) for k, n, c in comps), key=repr)
    docs = frame(spark, texts, ids)
    kept = one_of_each(docs, 4, 85)
    assert kept.columns == docs.columns and kept.count() == len({c for _, _, c in comps})


def test_every_row_is_searched(spark):
    rnd = random.Random(23)
    texts = some_texts(rnd)
    ids = any_ids(len(texts))
    items = [(1, texts[0]), (2, "alone"), (3, " ".join(texts[1].split()[5:30]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = [(ids[r[0]], *r[1:]) for r in brute_hits(texts, items)]
    docs = frame(spark, texts, ids)
    got = sorted(rows(dec.decontaminate(docs, bench), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"), key=repr)
    assert got == sorted(want, key=repr)
    clean = dec.without_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(rows(clean, "doc_id", "text"), key=repr) == sorted(((i, t) for i, t, r in zip(ids, texts, brute_hits(texts, items)) if not r[-1]), key=repr)


# ------------------------------------------------------------------ decontamination

def brute_hits(texts, items, size=13):
    find = lambda t: [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t or "")]
    wins = {}
    for k, t in items:
        w = find(t)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            wins.setdefault(tuple(w[i:i + size]), set()).add(k)
    out = []
    for d, t in enumerate(texts):
        w, hit, its = find(t), set(), set()
        for x, ks in wins.items():
            for i in range(len(w) - len(x) + 1):
                if tuple(w[i:i + len(x)]) == x:
                    hit |= set(range(i, i + len(x)))
                    its |= ks
        names = ",".join(sorted(str(k) for k in its))
        out.append((d, len(w), len(hit), len(its), hashlib.sha256(names.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def test_decontamination(spark):
    rnd = random.Random(4)
    vocab = ["the", "of", "And", "é1", "x9"] + [f"t{i}" for i in range(60)]
    items = [(k, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([1, 2, 12, 13, 14, 30])))) for k in range(20)] + [(20, None), (21, "...")]
    texts = [" ".join(rnd.choice(vocab) for _ in range(rnd.randrange(60))) for _ in range(40)]
    for k, x in items[:15]:
        texts.append("Start, " + (x or "").upper().replace("É", "é").replace(" ", " -- ") + " end")
    texts += ["the " * 40, None, ""]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = rows(dec.decontaminate(frame(spark, texts), bench), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == brute_hits(texts, items)


def test_decontamination_odd(spark, odd):
    bench = spark.createDataFrame([(None, "one two three four five"), (3, None), (4, "short"), (4, "short")], "item_id long, text string")
    got = {r["doc_id"]: r for r in dec.decontaminate(odd, bench).collect()}
    assert got[4]["n_hit"] == 5 and got[4]["n_items"] == 0 and got[9]["n_items"] == 1 and got[9]["contaminated"]
    assert got[1]["n_words"] == 0 and not got[1]["contaminated"] and got[None]["n_words"] == 2 and dec.decontaminate(odd, bench).count() == 11
    assert dec.decontaminate(odd.filter("false"), bench).collect() == []
    assert not any(r["contaminated"] for r in dec.decontaminate(odd, bench.filter("false")).collect())


def test_proximity(spark):
    docs = frame(spark, ["zero one two three extra four five six", "six five four three two one", None])
    bench = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    assert {r.doc_id for r in dec.proximity_matches(docs, bench, slack=1).collect()} == {0}
    assert dec.proximity_matches(docs, bench, slack=0).collect() == []


# ------------------------------------------------------------------ URL rules

def test_stated_rules(spark):
    urls = [(1, "http://a.example.org/es/x"), (2, "https://EXAMPLE.org/en/12?q=://z"), (3, "http://b.org/q"), (4, "x.com/fr/"), (5, None),
            (6, "http://m.x.com/de/1#a"), (7, "ftp://com/fr/"), (8, "http://notexample.org/es/"), (9, ""), (9, ""), (None, "http://c.net"),
            (10, "http://a.com/FR/")]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    got = {r.page_id: tuple(r)[1:] for r in url_rules.filter_urls(pages, pages.selectExpr("url", "false as bad").filter("false")).collect()}
    assert got[1] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[2] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert got[3] == ("b.org", "/q", "org/", "allow") and got[4] == ("", "", None, "allow") and got[5] == ("", "", None, "allow")
    assert got[6][2:] == ("com/de/", "block") and got[7] == ("com", "/fr/", "com/fr/", "allow") and got[8][2:] == ("org/", "allow")
    assert got[10] == ("a.com", "/FR/", None, "allow") and got[None] == ("c.net", "", None, "allow")
    assert url_rules.filter_urls(pages.filter("false"), pages.selectExpr("url", "true as bad")).collect() == []


def test_mined_rules_against_brute_force(spark):
    rnd = random.Random(3)
    rows_ = []
    for i in range(300):
        spam = rnd.random() < 0.4
        rows_.append((i, f"http://{'casino' if spam else 'news'}{'.m' if rnd.random() < .5 else ''}.net/{'win' if spam and rnd.random() < .7 else 'a'}/{i}",
                      spam if rnd.random() < 0.95 else not spam))
    labelled = spark.createDataFrame(rows_, "page_id long, url string, bad boolean")
    mined = url_rules.mine(labelled, 15, 0.7).collect()
    tokens = [(frozenset(r.t), b) for r, (_, _, b) in zip(labelled.orderBy("page_id").select(url_rules.url_tokens(labelled["url"]).alias("t")).collect(), rows_)]
    holds, right = {}, {}
    for t, b in tokens:
        for n in range(1, len(t) + 1):
            for part in combinations(sorted(t), n):
                holds[part] = holds.get(part, 0) + 1
                right[part, b] = right.get((part, b), 0) + 1
    sure = {(p, b): n / holds[p] for (p, b), n in right.items() if n >= 15 and n / holds[p] >= 0.7}
    # Pruned: a rule that one with a token less already gives as surely.
    want = {k: c for k, c in sure.items() if not any(sure.get((tuple(x for x in k[0] if x != y), k[1]), 0) >= c for y in k[0])}
    assert {(tuple(r.tokens), r.verdict == "block"): pytest.approx(r.confidence) for r in mined} == want and len(want) > 3
    assert all(r.support == pytest.approx(right[tuple(r.tokens), r.verdict == "block"] / 300) for r in mined)
    got = {r.page_id: r.verdict for r in url_rules.filter_urls(labelled, labelled, min_pages=15, min_confidence=0.7).collect()}
    for (i, _, _), (t, _) in zip(rows_, tokens):
        fired = {k: c for k, c in want.items() if set(k[0]) <= t}
        best = max(((c, b) for (p, b), c in fired.items() if not any(set(p) < set(q) for q, _ in fired)), default=(0, False))
        assert got[i] == ("block" if best[1] else "allow")
    assert url_rules.mine(labelled.limit(14), 15).collect() == []  # no rule from fewer pages, whatever the share


# ------------------------------------------------------------------ licences

def test_licences(spark, odd):
    texts = ["foo bar\nReleased under the MIT License. baz", "Licensed under the Apache License, Version 2.0.", "nothing here at all to see",
             "released under the gpl license", LONG + " Licensed under CC BY-NC 4.0. " + LONG, None,
             "This work is licensed under the GNU General Public License, version 3."]
    got = rows(license_scan.scan(frame(spark, texts), license_scan.templates(spark)), "doc_id", "license", "first_word")
    assert got == [(0, "MIT", 2), (1, "Apache-2.0", 0), (4, "CC-BY-NC-4.0", 30000), (6, "GPL-3.0", 0)]
    assert license_scan.scan(odd, license_scan.templates(spark)).collect() == []
    assert license_scan.scan(odd.filter("false"), license_scan.templates(spark)).collect() == []
    own = license_scan.templates(spark, {"five": "one two three four five"})
    assert rows(license_scan.scan(odd, own), "doc_id", "license") == [(4, "five"), (5, "five")]


def test_licences_short_and_standard_texts(spark):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
           "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
           "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following")
    gpl = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU %sGeneral Public License as published by "
           "the Free Software Foundation, either version %d of the License, or (at your option) any later version.")
    texts = ["All rights reserved.", "a b\n(c) 2020 X. ALL RIGHTS\nreserved! all rights reserved", "all rights are reserved", "rights reserved all", mit,
             gpl % ("", 3), gpl % ("", 2), gpl % ("Lesser ", 3), "All rights", None,
             "Licensed under the Apache License, Version 2.0 (the \"License\");\n# you may not use this file except in compliance with the License.",
             "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."]
    got = rows(license_scan.scan(frame(spark, texts), license_scan.templates(spark)), "doc_id", "license", "first_word")
    assert got == [(0, "all-rights-reserved", 0), (1, "all-rights-reserved", 5), (4, "MIT-permission", 0), (5, "GPL-3.0-notice", 13),
                   (10, "Apache-2.0", 0), (10, "Apache-2.0-notice", 0), (11, "CC-BY-NC-4.0-notice", 0)]
    own = license_scan.templates(spark, {"one": "public", "two": "all rights", "none": " - "})
    assert rows(license_scan.scan(frame(spark, ["All rights", "Public", "public all rights", ""]), own), "doc_id", "license", "first_word", "containment") == [
        (0, "two", 0, 1.0), (1, "one", 0, 1.0), (2, "one", 0, 1.0), (2, "two", 1, 1.0)]


def test_licence_bands_choose_the_pairs(spark, monkeypatch):
    """Whole licence texts are found; with few bands only pairs that met one are, and an empty template table finds none."""
    from titlepulse.llm.license_texts import TEMPLATES

    texts = [f"intro {i} words\n{t}\nmore {i}" for i, t in enumerate(TEMPLATES.values())]
    want = {(i, name) for i, name in enumerate(TEMPLATES)}
    got = set(rows(license_scan.scan(frame(spark, texts), license_scan.templates(spark)), "doc_id", "license"))
    assert want <= got
    monkeypatch.setattr(license_scan, "BANDS", 1)
    few = set(rows(license_scan.scan(frame(spark, texts), license_scan.templates(spark)), "doc_id", "license"))
    assert few < got and any(name.endswith("-text") for _, name in few)
    none = license_scan.templates(spark, {"none": " "})
    assert license_scan.scan(frame(spark, texts), none).collect() == []


# ------------------------------------------------------------------ WARC audit

def test_warc_audit(spark):
    pages = spark.createDataFrame([(i if i != 7 else None, f"http://h/{i}" if i % 5 else None, "é" * i if i % 4 else None) for i in range(80)]
                                  + [(3, "http://h/3", "again"), (3, "http://h/3", "again")], "page_id long, url string, html string")
    a = warc_merkle.archive(pages, 20)
    assert warc_merkle.audit(a, a).collect() == []
    damaged = warc_merkle.damaged_copy(a, 10, 4)
    got = warc_merkle.audit(a, damaged).collect()
    assert sorted(r.page_id for r in got) == [4, 14, 24, 34, 44, 54, 64, 74] and all(r.found and r.found != r.sha256 for r in got)
    raw = {(r.file_id, r.off): bytes(r.record) for r in a.collect()}
    for f in {f for f, _ in raw}:
        end = 0
        for off in sorted(o for g, o in raw if g == f):
            assert off == end
            end += len(raw[f, off])
    loose = warc_merkle.archive(spark.createDataFrame([(None, f"u{i}", None) for i in range(40)], "page_id long, url string, html string"))
    assert loose.select("file_id").distinct().count() > 20  # pages without id are dealt to many files
    first = loose.orderBy("file_id").first()
    assert [r.file_id for r in warc_merkle.audit(loose, loose.filter(f"file_id <> {first.file_id}")).collect()].count(first.file_id) >= 1
    missing = warc_merkle.audit(a, a.filter("not (file_id = 1 and seq = 2)")).collect()
    assert [(r.file_id, r.found) for r in missing] == [(1, None)]
    none = pages.filter("false")
    assert warc_merkle.audit(warc_merkle.archive(none), warc_merkle.archive(none)).collect() == []


# ------------------------------------------------------------------ classifiers

@pytest.fixture(scope="module")
def sites(spark):
    rnd = random.Random(11)
    vocab = [f"wo{chr(97 + i % 26)}{i}" for i in range(200)]
    docs, labels = [], []
    for i in range(600):
        kind = rnd.random()
        words = [rnd.choice(vocab) for _ in range(rnd.randrange(20, 80))]
        if kind < 0.2:
            words = [w + "$$$" for w in words]
        toxic = rnd.random() < 0.2
        if toxic:
            for _ in range(3):
                words.insert(rnd.randrange(len(words)), "idiot")
        docs.append((i, " ".join(words), rnd.choice(["en", "fr"]), f"s{i % 7}", 0))
        labels.append((i, int(kind >= 0.2), int(toxic)))
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_site_quality_on_held_out_rows(sites):
    docs, labels = sites
    got = {r.doc_id: r for r in site_quality(docs, labels.filter("doc_id < 300")).collect()}
    truth = {r.doc_id: r for r in labels.collect()}
    right = sum(got[i].keep == (truth[i].quality == 1 and truth[i].toxic == 0) for i in range(300, 600))
    assert right >= 290 and len(got) == 600
    kept = keep_good(docs, labels.filter("doc_id < 300"))
    assert kept.columns == docs.columns and kept.count() == sum(r.keep for r in got.values())


def test_site_quality_odd(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = site_quality(odd, none).collect()
    assert len(got) == 11 and all(0 <= r.quality <= 1 and 0 <= r.toxic <= 1 for r in got)
    some = spark.createDataFrame([(4, 1, 0), (None, 1, 1), (6, 0, 1), (9, None, 0), (9, 1, 0)], "doc_id long, quality int, toxic int")
    assert keep_good(odd, some).columns == odd.columns
    assert site_quality(odd.filter("false"), some).collect() == []


def test_site_quality_without_labels_keeps_all(spark, sites, odd):
    docs, labels = sites
    no_match = labels.selectExpr("doc_id + 100000 as doc_id", "quality", "toxic")
    for some in (labels.filter("false"), no_match, labels.selectExpr("doc_id", "cast(null as int) as quality", "cast(null as int) as toxic")):
        got = site_quality(docs, some).collect()
        assert len(got) == 600 and all(r.keep and r.quality == r.toxic == 0.5 for r in got)
    assert keep_good(odd, labels.filter("false")).count() == odd.count()


@pytest.mark.parametrize("head", ["quality", "toxic"])
def test_site_quality_with_labels_of_one_kind(sites, head):
    docs, labels = sites
    truth = {r.doc_id: getattr(r, head) for r in labels.collect()}
    other = ({"quality", "toxic"} - {head}).pop()
    got = {r.doc_id: r for r in site_quality(docs, labels.filter("doc_id < 300").selectExpr("doc_id", head, f"cast(null as int) as {other}")).collect()}
    assert all(getattr(r, other) == 0.5 for r in got.values()) and all(r.keep == (r.quality >= 0.5 if head == "quality" else r.toxic < 0.5) for r in got.values())
    assert sum(got[i].keep == (truth[i] == (head == "quality")) for i in range(300, 600)) >= 290


def test_site_quality_with_labels_on_different_rows(sites):
    docs, labels = sites
    split = labels.filter("doc_id < 400").selectExpr("doc_id", "if(doc_id % 2 = 0, quality, null) as quality", "if(doc_id % 2 = 1, toxic, null) as toxic")
    truth = {r.doc_id: r for r in labels.collect()}
    got = {r.doc_id: r for r in site_quality(docs, split, fit_rows=200).collect()}
    assert sum(got[i].keep == (truth[i].quality == 1 and truth[i].toxic == 0) for i in range(400, 600)) >= 185


def test_mixing_meets_its_targets(spark):
    rnd = random.Random(5)
    docs = [(i, " ".join(rnd.choice(["aa", "bb", "cc"] if i % 4 else ["xx", "yy", "zz"]) for _ in range(rnd.randrange(5, 60))), None, None, 0)
            for i in range(400)] + [(400, None, None, None, None), (401, "", None, None, None)]
    df = spark.createDataFrame(docs, DOCS)
    labelled = df.filter("doc_id < 100").selectExpr("doc_id", "text", "case when doc_id % 4 = 0 then 'x' else 'a' end as domain")
    got = mixing.soft_mixing(df, labelled, {"a": 1.0, "x": 3.0}).collect()
    total = sum(r.n_tokens for r in got)
    assert sum(r.rate * r.n_tokens * r.p_x for r in got) / total == pytest.approx(0.75, abs=2e-4)
    assert sum(r.rate * r.n_tokens * r.p_a for r in got) / total == pytest.approx(0.25, abs=2e-4)
    assert all(r.rate >= 0 for r in got) and len(got) == 402
    # The rates are those of the least-squares problem solved directly: r = max(0, 1 - p . m) for one m.
    p, r = np.asarray([[x.p_a, x.p_x] for x in got]), np.asarray([x.rate for x in got])
    m, *_ = np.linalg.lstsq(p[r > 0], (1 - r)[r > 0], rcond=None)
    assert np.abs(np.maximum(0, 1 - p @ m) - r).max() < 1e-3
    copies = mixing.resampled(df, labelled, {"a": 1.0, "x": 3.0})
    assert copies.columns == df.columns and abs(copies.count() - r.sum()) < 40


@pytest.mark.parametrize("shares", [(0.3, 0.697, 0.001, 0.002), (0.3, 0.6996, 0.0002, 0.0002), (0.01, 0.97, 0.01, 0.01), (0.25, 0.25, 0.25, 0.25)])
def test_mixing_meets_targets_of_skewed_domains(spark, shares):
    p = [[0.99 if i == d else 0.01 / 3 for i in range(4)] for d in range(4)]
    members = spark.createDataFrame([(float(s * 1e6), x) for s, x in zip(shares, p)], "t double, p array<double>")
    target = np.asarray([0.2, 0.5, 0.15, 0.15])
    m, off = mixing.fit_rates(members, target)
    r = np.maximum(0, 1 - np.asarray(p) @ m)
    assert off <= 5e-5 and np.abs((np.asarray(shares) * r) @ np.asarray(p) - target).max() <= 5.1e-5


def test_mixing_reports_targets_that_cannot_be_met(spark):
    p, t = np.asarray([[0.9, 0.1], [0.6, 0.4]]), np.asarray([0.5, 0.5])
    members = spark.createDataFrame([(float(a), [float(y) for y in x]) for a, x in zip(t, p)], "t double, p array<double>")
    with pytest.warns(UserWarning, match="miss a target share"):
        m, off = mixing.fit_rates(members, np.asarray([0.1, 0.9]))
    # The nearest point of the cone of (0.9, 0.1) and (0.6, 0.4) to (0.1, 0.9) lies on the latter.
    best = np.asarray([0.6, 0.4]) * (np.asarray([0.6, 0.4]) @ [0.1, 0.9]) / 0.52
    r = np.maximum(0, 1 - p @ m)
    assert np.abs((t * r) @ p - best).max() < 1e-3 and off == pytest.approx(np.abs(best - [0.1, 0.9]).max(), abs=1e-3)


def test_mixing_odd(spark, odd):
    labelled = odd.selectExpr("doc_id", "text", "cast(null as string) as domain")
    got = mixing.soft_mixing(odd, labelled, {"a": 1.0, "b": 1.0}).collect()
    assert len(got) == 11 and all(r.rate == pytest.approx(1, abs=1e-3) for r in got)
    assert mixing.soft_mixing(odd.filter("false"), labelled, {"a": 1.0}).collect() == []
    assert mixing.resampled(odd, labelled, {"a": 1.0, "b": 1.0}).columns == odd.columns
