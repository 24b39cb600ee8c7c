"""Training-order materialisation: every token sequence gets a slot by a keyed permutation; shards of fixed stride hold the slots in order.

The permutation is a Feistel network over the smallest even-bit domain that holds all slots; values that leave the range
walk the cycle until they are back. So slot and sequence number follow from each other without a table, and shard k
holds slots k * rows to (k + 1) * rows: a reader resumes at any slot by one division.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import batches_of, cut, small, text_of

SEQUENCE_TOKENS, SHARD_ROWS, ROUNDS = 1024, 2048, 6
#: How byte-level vocabularies of this kind split a text; fixed by the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteTokenizer:
    """Bytes as tokens, with an end token after them; needs no vocabulary."""

    end = 256

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.uint16)

    def decode(self, tokens: np.ndarray) -> str:
        return tokens.astype(np.uint8).tobytes().decode("utf-8", "surrogatepass")


class RankTokenizer:
    """A byte-pair vocabulary from a file of base64 tokens and ranks; the first free number is the end token."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.ranks, self.pattern = ranks, pattern
        self.end = max(ranks.values()) + 1
        if self.end >= 1 << 16:
            raise ValueError("token ids must fit in 16 bits")

    @classmethod
    def from_file(cls, path: str, pattern: str = PATTERN) -> RankTokenizer:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, pattern)

    @property
    def _encoding(self) -> tiktoken.Encoding:
        return _encoding(self)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self._encoding.encode_ordinary(text), dtype=np.uint16)

    def decode(self, tokens: np.ndarray) -> str:
        return self._encoding.decode_bytes(tokens.tolist()).decode("utf-8", "surrogatepass")


@lru_cache(maxsize=2)
def _encoding(tokenizer: RankTokenizer) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=tokenizer.pattern, mergeable_ranks=tokenizer.ranks, special_tokens={})


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permute(values: np.ndarray, n: int, key: int, inverse: bool = False) -> np.ndarray:
    """The place of each value in a keyed permutation of range(n), or back."""
    half = max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    rounds = [((key + r + 1) * 0xD1342543DE82EF95) & 0xFFFFFFFFFFFFFFFF for r in range(ROUNDS)]
    out = np.asarray(values).astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for k in reversed(rounds) if inverse else rounds:
            if inverse:
                left, right = right ^ (_mixed(left, k) & mask), left
            else:
                left, right = right, left ^ (_mixed(right, k) & mask)
        out[todo] = left << np.uint64(half) | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def _sequences(tokenizer, size: int):
    """(doc_id, key, text) -> (doc_id, key, seq, n_tokens, tokens): the text's tokens and an end token, cut into compressed records of ``size`` tokens."""

    def run(batches):
        compressor = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            rows, room = [], 0
            for doc_id, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                tokens = np.append(tokenizer.encode(text.as_py()), np.uint16(tokenizer.end)).astype("<u2")
                for k in range(0, len(tokens), size):
                    part = tokens[k : k + size]
                    rows.append((doc_id, key, k // size, len(part), compressor.compress(part.tobytes())))
                    room += 2 * size
                    if room >= 4 << 20:
                        yield _batch(rows)
                        rows, room = [], 0
            if rows:
                yield _batch(rows)

    def _batch(rows):
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "key", "seq", "n_tokens", "tokens"])

    return run


def _slots(n: int, key: int, rows: int):
    def run(batches):
        for batch in batches:
            slot = permute(batch.column(0).to_numpy(), n, key)
            yield pa.RecordBatch.from_arrays([pa.array(slot // rows), pa.array(slot), *batch.columns[1:]], names=["shard", "slot", "doc_id", "seq", "n_tokens", "tokens"])

    return run


def _shards(n: int, rows: int, size: int, end: int):
    """Rows in the order of their slots -> a row for each shard."""

    def row(shard: int, doc_ids, seqs, n_tokens, payload: bytearray):
        one = lambda c, kind: pa.array([c], pa.list_(kind))
        columns = {
            "shard": pa.array([shard], pa.int64()), "first_slot": pa.array([shard * rows], pa.int64()), "n_rows": pa.array([len(seqs)], pa.int32()), "stride": pa.array([2 * size], pa.int32()),
            "doc_ids": one(doc_ids, pa.int64()), "seqs": one(seqs, pa.int32()), "n_tokens": one(n_tokens, pa.int32()), "payload": pa.array([bytes(payload)], pa.binary()),
        }
        return pa.RecordBatch.from_pydict(columns)

    def run(batches):
        decompressor = zstandard.ZstdDecompressor()
        padding = np.full(size, end, dtype="<u2").tobytes()
        doc_ids, seqs, counts, payload, expected = [], [], [], bytearray(), None
        for batch in batches:
            for slot, doc_id, seq, count, tokens in zip(*(batch.column(c).to_pylist() for c in ("slot", "doc_id", "seq", "n_tokens", "tokens")), strict=True):
                if slot != (slot - slot % rows if not seqs else expected):
                    raise ValueError(f"slot {slot} where {expected} was due")
                doc_ids.append(doc_id)
                seqs.append(seq)
                counts.append(count)
                payload += decompressor.decompress(tokens) + padding[2 * count :]
                expected = slot + 1
                if expected % rows == 0 or expected == n:
                    yield row(slot // rows, doc_ids, seqs, counts, payload)
                    doc_ids, seqs, counts, payload = [], [], [], bytearray()
        if seqs:
            raise ValueError(f"slot {expected} is missing")

    return run


_SHARDS = "shard long, first_slot long, n_rows int, stride int, doc_ids array<long>, seqs array<int>, n_tokens array<int>, payload binary"


def materialise(
    docs: DataFrame, tokenizer=None, key: int = 0, sequence_tokens: int = SEQUENCE_TOKENS, shard_rows: int = SHARD_ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Tokenise ``docs`` and lay all sequences out in the training order of ``key``.

    A document is its tokens and an end token, in sequences of ``sequence_tokens``; the last is filled up with end tokens.
    Returns one row for each shard: shard, first_slot, n_rows, stride (bytes of a record), doc_ids, seqs and n_tokens of
    its records, payload (n_rows records of little-endian 16-bit tokens). All shards but the last have ``shard_rows``
    records. Null and empty texts are one end token; rows that repeat an id are laid out each. An empty table gives no
    shard. Other columns are ignored. ``tokenizer`` is bytes by default.

    Sequences are numbered by their documents, in the order of a 64-bit hash of id and text, then by place in the text. So the order depends on the documents and ``key`` alone, however they are stored, and a rerun continues an
    earlier reader. Documents are sorted by ranges of that hash, tokenised once and staged in the shared folder; then
    every range of slots is sorted and written by one task.
    """
    if min(sequence_tokens, shard_rows) < 1:
        raise ValueError("sequence_tokens and shard_rows must be at least 1")
    spark = docs.sparkSession
    tokenizer = tokenizer or ByteTokenizer()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    # rows alike in both are interchangeable: a salt lets them be split over tasks
    rows = rows.select("doc_id", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text").alias("key"), "text", F.pmod(F.monotonically_increasing_id(), F.lit(1024)).alias("salt"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    ordered = rows.repartitionByRange(parts, "key", "doc_id", "salt").sortWithinPartitions("key", "doc_id", "salt").select("doc_id", "key", "text")
    with batches_of(spark, 1000):
        staged = cut(ordered.mapInArrow(_sequences(tokenizer, sequence_tokens), "doc_id long, key long, seq int, n_tokens int, tokens binary"), "tokens", narrow=False)
    files = staged.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("from"))
    files = cut(files, "token-files")
    n_files, n = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n:
        return spark.createDataFrame([], _SHARDS)
    # one row for each file, which holds a range of keys in order
    starts = files.selectExpr("file", "sum(n) OVER (ORDER BY from, file) - n AS start")
    placed = staged.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")).join(small(starts, n_files), "file")
    numbered = placed.select((F.col("start") + F.col("at")).alias("number"), "doc_id", "seq", "n_tokens", "tokens")
    slotted = numbered.mapInArrow(_slots(n, key, shard_rows), "shard long, slot long, doc_id long, seq int, n_tokens int, tokens binary")
    n_shards = -(-n // shard_rows)
    ranges = min(parts, n_shards)
    ranged = slotted.repartitionById(ranges, F.expr(f"int(shard * {ranges} div {n_shards})")).sortWithinPartitions("slot")
    return ranged.mapInArrow(_shards(n, shard_rows, sequence_tokens, tokenizer.end), _SHARDS)


def read(shards: DataFrame, from_slot: int = 0, shard_rows: int = SHARD_ROWS) -> Iterator[tuple[int, np.ndarray]]:
    """(slot, tokens) in training order from ``from_slot`` on: whole shards are skipped by number, then records by stride."""
    ahead = shards.where(F.col("shard") >= from_slot // shard_rows).select("shard", "first_slot", "stride", "payload").orderBy("shard")
    for r in ahead.toLocalIterator():
        data = np.frombuffer(r["payload"], dtype="<u2").reshape(-1, r["stride"] // 2)
        for k in range(max(0, from_slot - r["first_slot"]), len(data)):
            yield r["first_slot"] + k, data[k]
