"""Conversation trie: brute force, handles and searches, hot turns, odd input."""
import hashlib
import random
import zlib

import pyspark.sql.functions as F
import pytest

from titlepulse.llm import zfast_trie as zt

COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute_paths(rows):
    """{conv_id: rebuilt turns}."""
    name = lambda r, t: hashlib.sha256(f"{len(r.encode())}:{r}{t}".encode()).hexdigest()
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, name(role or "", text or ""), (role or "", text or "")))
    own = {c: [x[3] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = tuple(own.get(base, [])[:h] + turns[h:])
    return out


def brute(rows):
    paths = brute_paths(rows)
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], []).append(c)
    kids = {p: 0 for p in members}
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(str(c) for c in sorted(m) if len(paths[c]) == len(p)).encode()).hexdigest()) for p, m in members.items()), key=repr)


def run(spark, rows, batches=zt.BATCHES):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, name string")
    return sorted((tuple(r[c] for c in COLS) for r in zt.conversation_trie(df, batches).collect()), key=repr)


def random_rows(seed, convs, words, longest):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(4 * convs), convs):
        rows += [(c, k, rnd.choice(["user", "bot"]), rnd.choice(words)) for k in range(rnd.randrange(longest))]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,convs,words,longest,batches", [(1, 60, ["a", "é€"], 12, (1, 1, 1, 1)), (2, 40, ["x"], 30, (1, 3)), (3, 50, list("abcdefgh"), 14, (4,))])
def test_brute(spark, seed, convs, words, longest, batches):
    rows = random_rows(seed, convs, words, longest)
    assert run(spark, rows, batches) == brute(rows)


def test_hot_first_turn_and_copies(spark):
    """A third of the conversations begin alike, others are copies of one, one is long."""
    rows = [(c, 0, "system", "hello") for c in range(30)] + [(c, k, "user", f"t{c}-{k}") for c in range(30) for k in range(1, 10)]
    rows += [(c, k, "user", f"same{k}") for c in range(100, 130) for k in range(11)] + [(200, k, "user", f"long{k % 40}") for k in range(300)]
    rows += [(201, k, "user", f"long{k % 40}") for k in range(270)]
    assert run(spark, rows) == brute(rows)


def test_odd(spark):
    rows = [(None, 1, "user", "no conversation"), (1, None, "user", "first"), (1, None, None, None), (1, 0, "user", None), (1, 0, "user", None),
            (2, 5, "", ""), (-3, 1, "user", "a"), (-3, 2, "user", "b" * 200_000), (0, 1, "user", "a"), (0, 1, "user", "a"), (10, 3, "a", "ba"), (15, 3, "ab", "a")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == [] and run(spark, rows[:1]) == []


def test_fattest(spark):
    pairs = [(a, b) for b in range(1, 40) for a in range(b)]
    df = spark.createDataFrame(pairs, "lo long, hi long").select("lo", "hi", zt.fattest("lo", "hi").alias("f"))
    for lo, hi, f in df.collect():
        assert f == max(range(lo + 1, hi + 1), key=lambda x: ((x & -x), -x))


def test_search_and_handles(spark):
    """Every inserted conversation is found whole; nodes are keyed by their own handles."""
    rows = random_rows(9, 50, ["a", "b"], 20)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    convs, paths = zt.rebuilt(df)
    strings, nodes, longest = zt.build(convs, paths, (1, 2, 1))
    want = {p[:d] for p in brute_paths(rows).values() for d in range(1, len(p) + 1)}
    ends = set(brute_paths(rows).values()) - {()}
    forks = {p for p in want if len({q for q in want if q[:-1] == p}) > 1}
    assert nodes.count() == len(ends | forks)
    assert nodes.groupBy("handle", "fa", "fb").count().filter("count > 1").isEmpty()
    assert nodes.filter("handle <= up or handle > depth").isEmpty()
    found = zt.search(strings.filter("n > 0").select("rep", "n"), paths, nodes, longest)
    assert found.filter(F.col("base") != F.col("n")).isEmpty()
