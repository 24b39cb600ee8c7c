"""Toxicity by compression distance: how much shorter a text gets with a dictionary of toxic text than with one of ordinary text.

Each dictionary is trained on one class: it holds the segments that cover its examples and that the other class lacks,
and both end with the same slice of ordinary text, so that what is common to both classes costs the same. A window is compressed with each (fast parse, literals stored raw, so that a
match saves whole bytes); what the toxic dictionary saves over all windows of a text is calibrated by a logistic model,
which sees differences of compressed lengths and nothing else. Segments are chosen here, not by the library's trainer: that
looks for what is common within a class, and most of that is common to both.
"""

from __future__ import annotations

import heapq
import zlib
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import text_of

WINDOW = 256
#: Bytes that a window shares with the next, so that no segment is cut in all windows.
OVERLAP = 16
MIN_MATCH = 5
#: Bound of the labelled sample that the model is fitted on: rows and normalised bytes of each class, and the longest text taken.
SAMPLE_ROWS, SAMPLE_BYTES, SAMPLE_TEXT = 2000, 4_000_000, 50_000
#: A dictionary: length and number of its segments; in how many texts of its class a piece of one must be, up to how many
#: occurrences count of each text, and how much an occurrence in the other class weighs against one in its own.
SEGMENT_BYTES, SEGMENTS = 24, 200
MIN_TEXTS, MIN_SHARE, MOST_TIMES, AGAINST = 3, 0.005, 8, 8.0
#: Bytes at the start of a word that are told from the same bytes further in.
START = 4
BASE_BYTES, HEAD_BYTES = 64, 64
FOLDS = 4

# Lower-case ASCII letters, digits and all bytes beyond ASCII stay; the rest becomes a space.
_WORD_BYTES = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else 32 for c in range(256))


def normalise(text: str | None) -> bytes:
    """Words in lower case, each with a space before and after; letters among the first START bytes are capitals, so that no match begins inside another word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().translate(_WORD_BYTES).split()
    return b" " + b" ".join([w[:START].upper() + w[START:] for w in words]) + b" " if words else b""


def _pieces(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The code of the MIN_MATCH bytes from every position of the joined texts on, and the text of the position; -1 where a text ends before."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts])
    n = max(0, len(data) - MIN_MATCH + 1)
    code = np.zeros(n, dtype=np.int64)
    for j in range(MIN_MATCH):
        code <<= 8
        code |= data[j : j + n]
    code[doc[:n] != doc[len(doc) - n :]] = -1
    return code, doc[:n]


def _frequencies(code: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct codes, in how many texts each is, and its occurrences, of each text MOST_TIMES at most."""
    inside = code >= 0
    both = np.sort(code[inside] << 20 | doc[inside])
    start = np.flatnonzero(np.diff(both, prepend=-1))
    times = np.minimum(np.diff(np.append(start, len(both))), MOST_TIMES)
    codes = both[start] >> 20
    first = np.flatnonzero(np.diff(codes, prepend=-1))
    return codes[first], np.diff(np.append(first, len(codes))), np.add.reduceat(times, first) if len(first) else times


def own_segments(mine: list[bytes], others: list[bytes]) -> list[bytes]:
    """Segments that together cover the texts of one class, the one that saves most first.

    A segment is a run of pieces of MIN_MATCH bytes each of which occurs more than AGAINST times as often in this class as
    in the other, for its bytes; what it saves is weighed against what it would save there. A text that is covered already
    counts half for each segment it has.
    """
    code, doc = _pieces(mine)
    codes, df, times = _frequencies(code, doc)
    ocodes, _, otimes = _frequencies(*_pieces(others))
    if not len(codes):
        return []
    where = np.minimum(np.searchsorted(ocodes, codes), max(0, len(ocodes) - 1))
    other = np.where(ocodes[where] == codes, otimes[where], 0) if len(ocodes) else np.zeros(len(codes), np.int64)
    against = AGAINST * (other + 0.5) * len(code) / max(len(code) if not others else 1, sum(map(len, others)))
    good = (df >= max(MIN_TEXTS, MIN_SHARE * len(mine))) & (times > against)
    cost = dict(zip(codes[good].tolist(), against[good].tolist(), strict=True))
    mark = np.isin(code, codes[good])
    edge = np.diff(np.concatenate([[0], mark.astype(np.int8), [0]]))
    joined = b"".join(mine)
    texts: dict[bytes, dict[int, int]] = {}
    least: dict[bytes, float] = {}
    for start, end in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
        end = min(end, start + SEGMENT_BYTES - MIN_MATCH + 1)
        segment = joined[start : end + MIN_MATCH - 1]
        seen = texts.setdefault(segment, {})
        d = int(doc[start])
        seen[d] = min(seen.get(d, 0) + 1, MOST_TIMES)
        if segment not in least:
            # the other class has the whole segment at most as often as its rarest piece
            least[segment] = min(cost[c] for c in code[start:end].tolist())
    weight = np.ones(len(mine))
    chosen: list[bytes] = []
    pieces: set[bytes] = set()
    # What a segment gains only falls as others are chosen: one whose gain still stands is the best.
    queue = [((least[s] - sum(d.values())) * (len(s) - 3), s, np.fromiter(d, dtype=np.int64), np.fromiter(d.values(), dtype=np.float64)) for s, d in texts.items()]
    heapq.heapify(queue)
    while queue and len(chosen) < SEGMENTS:
        gain, best, d, n = heapq.heappop(queue)
        now = (least[best] - float(weight[d] @ n)) * (len(best) - 3)
        if now >= -1:
            continue
        if now > gain:
            heapq.heappush(queue, (now, best, d, n))
            continue
        parts = {best[i : i + MIN_MATCH] for i in range(len(best) - MIN_MATCH + 1)}
        if not parts <= pieces:
            chosen.append(best)
            pieces |= parts
            weight[d] /= 2
    return chosen


def _base(ordinary: list[bytes]) -> bytes:
    slices = [t[len(t) // 2 : len(t) // 2 + 64] for t in ordinary if len(t) >= 128]
    step = max(1, len(slices) * 64 // BASE_BYTES)
    return b"".join(slices[::step]).ljust(BASE_BYTES, b"\x00")[-BASE_BYTES:]


@dataclass(frozen=True)
class Dictionaries:
    """The contents of both dictionaries; compressors are made where they are used."""

    ordinary: bytes
    toxic: bytes

    @cached_property
    def _compressors(self):
        made = []
        for content in (self.ordinary, self.toxic):
            params = zstandard.ZstdCompressionParameters.from_level(
                -1, min_match=MIN_MATCH, strategy=zstandard.STRATEGY_FAST, target_length=1, window_log=16, hash_log=16, chain_log=16,
                format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False,
            )
            shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            shared.precompute_compress(compression_params=params)
            made.append(zstandard.ZstdCompressor(dict_data=shared, compression_params=params))
        return made

    def __getstate__(self):
        return {"ordinary": self.ordinary, "toxic": self.toxic}

    def saved(self, text: bytes) -> np.ndarray:
        """Bytes that the toxic dictionary saves on each window. Windows follow a head of ordinary text, without which short ones would be stored raw."""
        ordinary, toxic = self._compressors
        head = self.ordinary[-HEAD_BYTES:]
        windows = [head + text[i : i + WINDOW + OVERLAP] for i in range(0, max(1, len(text)), WINDOW)]
        return np.array([len(ordinary.compress(w)) - len(toxic.compress(w)) for w in windows], dtype=np.float64)

    def features(self, text: bytes) -> list[float]:
        s = self.saved(text)
        up = np.maximum(s, 0)
        top = np.sort(s)[-3:]
        k = max(1.0, len(text) / WINDOW)
        return [
            np.log1p(up.sum()), np.log1p((s >= 2).sum()), np.log1p((s >= 4).sum()), min(float(top[-1]), 8.0), float(top.mean()), up.sum() / k,
            (s >= 3).sum() / k, float(s.mean()), float((s < 0).mean()),
        ]


@dataclass(frozen=True)
class Model:
    dictionaries: Dictionaries
    mean: list[float] = field(default_factory=list)
    scale: list[float] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)

    def score(self, text: str | None) -> float:
        x = (np.array(self.dictionaries.features(normalise(text))) - self.mean) / self.scale
        return float(1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30))))


def _dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> Dictionaries:
    base = _base(ordinary)
    made = []
    for mine, other in ((ordinary, toxic), (toxic, ordinary)):
        own = b"".join(s + b"\x00" for s in reversed(own_segments(mine, other)))
        # The encoder indexes a dictionary in steps: the shared part has to begin on the same step in both.
        made.append(own + b"\x00" * (-len(own) % 24) + base)
    return Dictionaries(*made)


def fit(texts: list[str | None], labels: list[int]) -> Model:
    """Fit dictionaries on all examples; the calibration sees each example with dictionaries that don't know it."""
    order = sorted(range(len(texts)), key=lambda i: (zlib.crc32(normalise(texts[i])), labels[i]))
    clean = [normalise(texts[i]) for i in order]
    y = np.array([1 if labels[i] else 0 for i in order])

    def trained(take: np.ndarray) -> Dictionaries:
        return _dictionaries([t for t, c, k in zip(clean, y, take, strict=True) if k and c], [t for t, c, k in zip(clean, y, take, strict=True) if k and not c])

    fold = np.zeros(len(clean), dtype=np.int64)
    for c in (0, 1):
        fold[y == c] = np.arange(int((y == c).sum())) % FOLDS
    x = np.zeros((len(clean), len(Dictionaries(b"\x00" * HEAD_BYTES, b"\x00" * HEAD_BYTES).features(b""))))
    for f in range(FOLDS):
        d = trained(fold != f)
        for i in np.flatnonzero(fold == f):
            x[i] = d.features(clean[i])
    mean, scale = (x.mean(axis=0), x.std(axis=0) + 1e-6) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
    a = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(a.shape[1])
    ridge = np.diag([1.0] * (len(w) - 1) + [1e-3])
    # Examples are weighted so that both classes count as in a corpus where a tenth is toxic.
    share = y.mean() if len(y) else 0.0
    each = np.where(y == 1, 0.1 / max(share, 1e-9), 0.9 / max(1 - share, 1e-9))
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        w = w - np.linalg.solve((a * (each * p * (1 - p))[:, None]).T @ a + ridge, a.T @ (each * (p - y)) + ridge @ w)
    return Model(trained(np.ones(len(clean), dtype=bool)), mean.tolist(), scale.tolist(), w.tolist())


def held_out(id_col: str | Column) -> Column:
    """A fifth of the ids, by CRC-32 of their text; never learnt from."""
    key = (F.col(id_col) if isinstance(id_col, str) else id_col).cast("string")
    return F.coalesce(F.crc32(key.cast("binary")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit a model on a bounded sample of the labelled documents that are not held out.

    The sample takes up to SAMPLE_ROWS documents of each class in the order of a digest of their id, leaves out texts of
    over SAMPLE_TEXT characters and stops at SAMPLE_BYTES. Null labels and ids are left out; of several labels of an id
    the largest counts.
    """
    known = labels.where(F.col(label_col).isNotNull() & ~held_out(id_col)).groupBy(id_col).agg(F.max(label_col).alias("_y"))
    # The sample is drawn from the labels: as many ids as the bound allows, then their texts.
    picked = None
    for c in (0, 1):
        mine = known.where(F.col("_y") == c).orderBy(F.md5(F.col(id_col).cast("string").cast("binary")), id_col).limit(SAMPLE_ROWS)
        picked = mine if picked is None else picked.unionByName(mine)
    picked = F.broadcast(picked.select(F.col(id_col).alias("_id"), "_y"))
    short = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text")).where(F.length("_text") <= SAMPLE_TEXT)
    rows = short.join(picked, "_id").select("_text", "_y", F.md5(F.col("_id").cast("string").cast("binary")).alias("_k"))
    budget = {0: SAMPLE_BYTES, 1: SAMPLE_BYTES}
    texts, ys = [], []
    for r in rows.orderBy("_k", "_text").toLocalIterator():
        if budget[r["_y"]] > 0:
            budget[r["_y"]] -= len(r["_text"].encode("utf-8", "surrogatepass"))
            texts.append(r["_text"])
            ys.append(r["_y"])
    return fit(texts, ys)


def _scores(model: Model):
    def run(batches):
        for batch in batches:
            scores = [model.score(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], names=[*batch.schema.names[:-1], "score"])

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row. Whole texts count; null and empty texts get the score of no windows; ids may repeat."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), text_of(text_col).alias("text"))
    out = rows.mapInArrow(_scores(model), "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _below(model: Model, at: int):
    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array([model.score(t.as_py()) < 0.5 for t in batch.column(at)], pa.bool_()))

    return run


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text scores 0.5 or more; all columns stay as they are.

    Whole texts count, a null one as an empty one; rows that repeat an id or a text are judged each. An empty table stays empty.
    """
    return docs.mapInArrow(_below(model, docs.columns.index(text_col)), docs.schema)
