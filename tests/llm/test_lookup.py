"""Keyed access to token shards: many keys, absent keys, repeated and null ids."""

import random

from titlepulse.llm import token_shards


def test_many_keys_over_many_shards(spark, tmp_path):
    rnd = random.Random(8)
    ids = rnd.sample(range(-10 ** 15, 10 ** 15), 700) + [-(1 << 63) + 1, (1 << 63) - 1]
    rows = [(i, " ".join(rnd.choice(["one", "two", "three"]) for _ in range(rnd.randrange(0, 40)))) for i in ids]
    rows += [(None, "none"), (ids[0], "again"), (ids[0], "again")]
    path = str(tmp_path / "shards")
    token_shards.write_shards(spark.createDataFrame(rows, "doc_id long, text string"), path, shard_tokens=200)
    assert spark.read.parquet(path).count() > 40
    encode = token_shards.encoder(token_shards.tokenizer_path("word_bpe_49k.json"))
    want = {i: token_shards._u4(encode(t.encode())).tolist() for i, t in rows[1:702]}
    keys = ids[1:702] + [i + 1 for i in ids[1:300] if i + 1 not in ids]
    got = token_shards.lookup(spark, path, keys).collect()
    assert {r.doc_id: list(r.ids) for r in got} == want and len(got) == len(want)
    first = token_shards.lookup(spark, path, [ids[0]]).collect()
    assert len(first) == 1 and list(first[0].ids) in [token_shards._u4(encode(t.encode())).tolist() for i, t in rows if i == ids[0]]
    assert token_shards.lookup(spark, path, []).collect() == []
    assert token_shards.lookup(spark, path, [max(ids) - 1]).collect() == []


def test_files_hold_few_shards(spark, tmp_path):
    """What a reader takes as one batch is bounded by the file."""
    import pyspark.sql.functions as F

    from titlepulse.llm import token_shards as S

    docs = spark.range(400).selectExpr("id as doc_id", "repeat('some words of a text ', 20) as text")
    S.write_shards(docs, str(tmp_path / "s"), shard_tokens=200)
    n = spark.read.parquet(str(tmp_path / "s")).groupBy(F.input_file_name()).count()
    assert n.agg(F.max("count")).first()[0] <= S.FILE_SHARDS < 400
    out = S.read_digests(spark, str(tmp_path / "s"))
    assert out.count() == 400 and out.agg(F.max(F.col("start") + F.col("n_tokens"))).first()[0] == out.agg(F.sum("n_tokens")).first()[0]
