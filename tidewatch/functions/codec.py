"""Wire frames of trade records: magic byte, schema id, schemaless Avro body. Decoding is rule R1.

Spark's own Avro functions are an optional package; these vectorised functions need none.
"""

from __future__ import annotations

import json
import struct
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAGIC = b"\x00"
#: The trade contract, version 1.
FIELDS: tuple[tuple[str, str], ...] = (
    ("exchange", "string"),
    ("symbol", "string"),
    ("trade_id", "string"),
    ("price", "double"),
    ("size", "double"),
    ("side", "string"),
    ("ts_event", "millis"),
    ("ts_ingest", "millis"),
)
NAMES = [n for n, _ in FIELDS]
_SPARK = {"string": T.StringType(), "double": T.DoubleType(), "millis": T.LongType()}
RECORD = T.StructType([T.StructField(n, _SPARK[k]) for n, k in FIELDS])
DECODED = T.StructType([*RECORD.fields, T.StructField("error", T.StringType())])


def avro_schema() -> dict[str, Any]:
    """The contract as an Avro schema."""
    kinds: dict[str, Any] = {"string": "string", "double": "double", "millis": {"type": "long", "logicalType": "timestamp-millis"}}
    return {"type": "record", "name": "Trade", "namespace": "trades.v1", "fields": [{"name": n, "type": kinds[k]} for n, k in FIELDS]}


def canonical_schema() -> str:
    return json.dumps(avro_schema(), separators=(",", ":"), sort_keys=True)


def _varint(value: int) -> bytes:
    rest = (value << 1 ^ value >> 63) & 0xFFFFFFFFFFFFFFFF
    out = bytearray()
    while rest > 127:
        out.append(rest & 127 | 128)
        rest >>= 7
    out.append(rest)
    return bytes(out)


def encode(record: dict[str, Any], schema_id: int = 1) -> bytes:
    parts = [MAGIC, struct.pack(">I", schema_id)]
    for name, kind in FIELDS:
        value = record[name]
        if kind == "string":
            raw = value.encode()
            parts += [_varint(len(raw)), raw]
        elif kind == "double":
            parts.append(struct.pack("<d", value))
        else:
            parts.append(_varint(int(value)))
    return b"".join(parts)


class _Reader:
    def __init__(self, data: bytes, at: int):
        self.data, self.at = data, at

    def take(self, n: int) -> bytes:
        if n < 0 or self.at + n > len(self.data):
            raise ValueError("truncated body")
        self.at += n
        return self.data[self.at - n : self.at]

    def long(self) -> int:
        out = shift = 0
        while True:
            byte = self.take(1)[0]
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                break
            if shift > 63:
                raise ValueError("number too long")
        out &= 0xFFFFFFFFFFFFFFFF
        return out >> 1 ^ -(out & 1)


def decode(frame: bytes) -> dict[str, Any]:
    """The record of a frame; ValueError for anything that is none. Bytes after a whole record are ignored."""
    if len(frame) < 5 or frame[:1] != MAGIC:
        raise ValueError("no frame header")
    body = _Reader(frame, 5)
    out: dict[str, Any] = {}
    for name, kind in FIELDS:
        if kind == "string":
            out[name] = body.take(body.long()).decode()
        elif kind == "double":
            out[name] = struct.unpack("<d", body.take(8))[0]
        else:
            out[name] = body.long()
    return out


@F.pandas_udf(T.BinaryType())
def _encode_rows(rows: pd.DataFrame) -> pd.Series:
    return pd.Series([encode(r) for r in rows.to_dict("records")], dtype=object)


def _decoded(frame: bytes) -> tuple:
    try:
        return (*decode(bytes(frame)).values(), None)
    except (ValueError, OverflowError) as wrong:
        return (*[None] * len(FIELDS), str(wrong) or type(wrong).__name__)


@F.pandas_udf(DECODED)
def _decode_frames(frames: pd.Series) -> pd.DataFrame:
    out = pd.DataFrame([_decoded(f) for f in frames], columns=[*NAMES, "error"], dtype=object)
    for name, kind in FIELDS:
        if kind == "millis":
            out[name] = out[name].astype("Int64")
        elif kind == "double":
            out[name] = out[name].astype("float64")
    return out


def encode_frames(trades: DataFrame, out: str = "value") -> DataFrame:
    """Add the frame of each record."""
    return trades.withColumn(out, _encode_rows(F.struct(*NAMES)))


def decode_frames(frames: DataFrame, value: str | Column = "value") -> DataFrame:
    """Replace nothing, add the columns of the record and ``malformed``. Null values are tombstones and dropped."""
    value = F.col(value) if isinstance(value, str) else value
    opened = frames.where(value.isNotNull()).withColumn("_d", _decode_frames(value))
    kept = [c for c in frames.columns if c not in NAMES]
    return opened.select(*kept, *[F.when(F.col("_d.error").isNull(), F.col(f"_d.{n}")).alias(n) for n in NAMES], F.col("_d.error").isNotNull().alias("malformed"), F.col("_d.error").alias("decode_error"))
