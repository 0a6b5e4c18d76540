"""Operator 1: token ids in binary shards with a minimal perfect hash index.

Documents are range-partitioned and sorted by doc_id, so that the shards of
partition 0, 1, ... in order hold all documents in ascending doc_id order.
Each task encodes its documents and writes shards of bounded size; a shard is

  payload       the ids of its documents, end ids included, as little-endian
                unsigned 32-bit integers, nothing else
  offsets       where each document's ids begin in the payload (n_docs + 1)
  seed, moves,  a minimal perfect hash from document key to position, with a
  marks, rank   stored 32-bit fingerprint per slot
  doc_ids, nth  the keys in order; nth counts rows that repeat a doc_id
  part, shard, token_start, first_id, last_id   its place

as one row of a Parquet table under the shared folder, so shards are written
and read by Spark on whatever store the cluster has. Row groups are small: a
reader that wants one key opens one shard by its id range and finds the ids
with two array reads.

Encoding: the tokenizer drops white space and no token spans it, so a text's
ids are the ids of its white-space separated pieces, one after the other
(checked in the tests against encoding whole texts); pieces are encoded once
per worker and looked up after that.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession, Window

from titlepulse.llm import mph
from titlepulse.llm.common import ship
from titlepulse.session import scratch_path

END_ID = 2
SHARD_TOKENS = 1 << 18
NO_ID = -(1 << 63)
#: Pieces that a worker keeps; it starts anew when it holds so many.
CACHED_PIECES = 1 << 20
#: Shards of one file. A reader takes what it is dealt as one Arrow batch, in the JVM and in Python.
FILE_SHARDS = 8
#: Spans of keys that a look-up compares with the shards' id ranges.
SPANS = 64

SHARD = ("part int, shard int, n_docs int, token_start long, n_tokens long, first_id long, last_id long, "
         "doc_ids binary, nth binary, null_ids binary, offsets binary, seed int, moves binary, marks binary, "
         "rank binary, payload binary")


class _Pieces(dict):
    """piece (bytes without white space) -> its ids as bytes."""

    def __init__(self, path: str, most: int):
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.most = most
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.to_chars = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.cores: dict[str, bytes] = {}
        self.plain = self._word_bpe(path)

    @staticmethod
    def _word_bpe(path: str) -> bool:
        """Whether words of plain letters may go to the model directly: the
        file must lower-case and split off letters as word_bpe_49k does."""
        import json

        with open(path, encoding="utf-8") as f:
            j = json.load(f)
        steps = [x.get("type") for x in (j.get("normalizer") or {}).get("normalizers", [])]
        split = str((j.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0].get("pattern"))
        return steps == ["NFC", "Replace", "Lowercase"] and "[\\\\p{L}]+|[\\\\p{N}]|[^\\\\s\\\\p{L}\\\\p{N}]+" in split

    def _ids(self, ids: list[int]) -> bytes:
        return np.asarray(ids, "<u4").tobytes()

    def _core(self, word: str) -> bytes:
        got = self.cores.get(word)
        if got is None:
            if not word.isascii():
                chars = "".join(x for x, _ in self.to_chars.pre_tokenize_str(word))
            else:
                chars = word
            got = self._ids([t.id for t in self.model.tokenize(chars)])
            if len(self.cores) >= self.most:
                self.cores.clear()
            self.cores[word] = got
        return got

    def __missing__(self, piece: bytes) -> bytes:
        text = piece.decode()
        m = PLAIN.fullmatch(text) if self.plain else None
        if m:
            got = self._core(m[1].lower()) + (self._core(m[2]) if m[2] else b"")
        else:
            got = self._ids(self.tok.encode(text, add_special_tokens=False).ids)
        if len(self) >= self.most:
            self.clear()
        self[piece] = got
        return got


#: Letters that need no normalising but lower case, then ASCII marks (no apostrophe, no < or >).
PLAIN = re.compile(r"([a-zA-ZÀ-ÖØ-öø-ÿ]+)([.,;:!?|#$%&*()/+=_-]*)")


@lru_cache(maxsize=2)
def _pieces(path: str, most: int) -> _Pieces:
    return _Pieces(path, most)


def encoder(path: str, end_id: int | None = END_ID, cached: int = CACHED_PIECES):
    """Function from a text's UTF-8 bytes to its ids as little-endian bytes."""
    pieces, end = _pieces(path, cached), b"" if end_id is None else np.asarray([end_id], "<u4").tobytes()
    get = pieces.__getitem__
    return lambda raw: b"".join(map(get, raw.split())) + end


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _shard_row(part: int, shard: int, start: int, ids: list, nth: list, sizes: list, payload: list) -> dict:
    keys = np.asarray([NO_ID if x is None else x for x in ids], np.int64)
    nulls = np.asarray([x is None for x in ids], np.uint8)
    ordinal = np.asarray(nth, np.int64)
    # A null key has the smallest id; bit 62 of the ordinal keeps it apart from a real one.
    seed, moves, marks, rank = mph.build(keys, ordinal + (nulls.astype(np.int64) << 62))
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype("<i8")
    real = keys[nulls == 0]
    return {"part": part, "shard": shard, "n_docs": len(ids), "token_start": start, "n_tokens": int(offsets[-1]),
            "first_id": int(real[0]) if len(real) else None, "last_id": int(real[-1]) if len(real) else None,
            "doc_ids": keys.astype("<i8").tobytes(), "nth": ordinal.astype("<i8").tobytes(), "null_ids": nulls.tobytes(),
            "offsets": offsets.tobytes(), "seed": seed, "moves": moves.astype("<i8").tobytes(),
            "marks": marks.astype("<u4").tobytes(), "rank": rank.astype("<u4").tobytes(), "payload": b"".join(payload)}


def _arrow_schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in SHARD.split(", ")])


def _writer(tokenizer: str, end_id: int, shard_tokens: int, cached: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pa.default_memory_pool().release_unused()  # what earlier tasks of this worker left
        encode, schema = encoder(tokenizer_path(tokenizer), end_id, cached), _arrow_schema()
        part = TaskContext.get().partitionId()
        ids: list = []
        nth: list = []
        sizes: list = []
        payload: list = []
        shard = start = held = count = 0
        last: object = object()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([_shard_row(part, shard, start, ids, nth, sizes, payload)], schema)

        for b in batches:
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                raw = encode(text.as_py().encode() if text.is_valid else b"")
                n = len(raw) // 4
                if ids and (held + n > shard_tokens or len(ids) >= 1 << 14):
                    yield out()
                    shard, start, held = shard + 1, start + held, 0
                    ids, nth, sizes, payload = [], [], [], []
                count = count + 1 if doc == last else 0
                last = doc
                ids.append(doc)
                nth.append(count)
                sizes.append(n)
                payload.append(raw)
                held += n
        if ids:
            yield out()

    return run


def write_shards(docs: DataFrame, path: str, tokenizer: str = "word_bpe_49k.json", end_id: int = END_ID,
                 shard_tokens: int = SHARD_TOKENS, cached: int = CACHED_PIECES) -> None:
    """Encode ``docs`` (doc_id, text) and write the shards to ``path``."""
    ship(docs.sparkSession)
    rows = docs.select("doc_id", "text").repartitionByRange("doc_id") \
        .sortWithinPartitions("doc_id", F.xxhash64("text"), F.length("text"))
    (rows.mapInArrow(_writer(tokenizer, end_id, shard_tokens, cached), SHARD)
     .write.option("compression", "zstd").option("maxRecordsPerFile", FILE_SHARDS).option("parquet.block.size", 8 << 20).parquet(path))


def _u4(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u4")


def _i8(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<i8")


def _open(row: dict, keys: np.ndarray, nth: np.ndarray) -> list[bytes | None]:
    """The payload slice of each key of one shard, through its hash index."""
    at = mph.find(keys, nth, row["seed"], _i8(row["moves"]), _u4(row["marks"]), _u4(row["rank"]))
    off, payload = _i8(row["offsets"]), memoryview(row["payload"])
    return [None if p < 0 else payload[4 * off[p]: 4 * off[p + 1]] for p in at], at, off


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pa.default_memory_pool().release_unused()
    for b in batches:
        for k in range(b.num_rows):
            row = b.slice(k, 1).to_pylist()[0]
            keys, nth, nulls = _i8(row["doc_ids"]), _i8(row["nth"]), np.frombuffer(row["null_ids"], np.uint8)
            parts, at, off = _open(row, keys, nth + (nulls.astype(np.int64) << 62))
            if any(p is None for p in parts):
                raise ValueError("a stored key is not in its shard's index")
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([row["part"]] * len(parts), pa.int32()),
                "doc_id": pa.array(keys, pa.int64(), mask=nulls.astype(bool)),
                "local_start": pa.array(row["token_start"] + off[at], pa.int64()),
                "n_tokens": pa.array([len(p) // 4 for p in parts], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(p) for p in parts], pa.int64())})


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, read back from the shards through their hash index:
    doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    ship(spark)
    shards = spark.read.parquet(path)
    # One row per written partition, whatever the number of documents.
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("t"))
    before = totals.select("part", (F.sum("t").over(Window.orderBy("part")) - F.col("t")).alias("base"))
    rows = shards.mapInArrow(_digests, "part int, doc_id long, local_start long, n_tokens long, ids_crc32 long")
    return rows.join(before, "part").select("doc_id", (F.col("base") + F.col("local_start")).alias("start"),
                                            "n_tokens", "ids_crc32")


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Ids of a stated list of keys: each key takes constant time in its shard,
    one look at the hash index and one at the key stored in the slot it names.
    Shards are chosen by at most ``SPANS`` spans of keys, split at the widest
    gaps, which the scan compares with the id ranges of its row groups. A key
    that is in no shard gives no row; one that repeats gives its first document."""
    ship(spark)
    wanted = np.unique(np.asarray(doc_ids, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                keys = wanted[np.searchsorted(wanted, row["first_id"]):np.searchsorted(wanted, row["last_id"], "right")]
                if not len(keys):
                    continue
                parts, at, _ = _open(row, keys, np.zeros(len(keys), np.int64))
                # A key that was never stored may have the fingerprint of its slot, but not its key.
                same = (_i8(row["doc_ids"])[at] == keys) & (_i8(row["nth"])[at] == 0) & (np.frombuffer(row["null_ids"], np.uint8)[at] == 0)
                found = [(k, _u4(p).tolist()) for k, p, s in zip(keys.tolist(), parts, same.tolist(), strict=True) if p is not None and s]
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array([k for k, _ in found], pa.int64()),
                                                  "ids": pa.array([i for _, i in found], pa.list_(pa.int64()))})

    gaps = np.diff(wanted.astype(object)).astype(float)  # exact: ids may span the whole range of 64 bits
    cuts = np.sort(np.argsort(-gaps, kind="stable")[:SPANS - 1]) + 1
    hit = F.lit(False)
    for span in np.split(wanted, cuts):
        if len(span):
            hit = hit | ((F.col("first_id") <= int(span[-1])) & (F.col("last_id") >= int(span[0])))
    return spark.read.parquet(path).filter(hit).mapInArrow(run, "doc_id long, ids array<long>")


def token_shards(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = END_ID,
                 shard_tokens: int = SHARD_TOKENS, cached: int = CACHED_PIECES) -> DataFrame:
    """Write shards under the shared folder and read every document back.
    ``cached`` pieces are kept by a worker: fewer need less memory, more time.

    Defined results: a null text is empty and has the end id alone; a null
    doc_id comes before all others; rows that repeat a doc_id are documents
    of their own, in the order of their text's hash; an empty table gives no
    rows; further columns are not read; a document longer than a shard makes
    a shard of its own."""
    spark = docs.sparkSession
    path = scratch_path(spark, "llm-token-shards")
    write_shards(docs, path, tokenizer, end_id, shard_tokens, cached)
    return read_digests(spark, path)
