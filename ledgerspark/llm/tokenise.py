"""Operator 10: SentencePiece encoding and decoding on the tokenizers library.

The model file's protobuf is parsed, and normaliser, metaspace marker, piece scores
and byte fallback are rebuilt for the ``tokenizers`` library (see
``sentencepiece_model``). Texts are encoded whole, in multithreaded batches, in one
pass without a shuffle; the ids are decoded again and compared with the text, and,
where asked for, the ids are compared with those of the sentencepiece library
itself, on every word where words encode independently, else on every text.

The model's bytes (under a megabyte) travel with the tasks; its path is read on the
driver only. A task keeps the ids of at most a quarter of a million words or so.

Defined cases: null text has null ids and no tokens, and counts as a round trip; an
empty text has no ids; repeated rows are encoded alike; texts that hold the marker
itself come back with spaces, so they are no round trip; an empty table gives an
empty result. Other columns pass through (input columns ``ids``, ``n_tokens``,
``n_byte_tokens``, ``decoded``, ``round_trip`` and ``parity`` are replaced).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm import sentencepiece_model
from ledgerspark.llm.blocks import blocks
from ledgerspark.llm.common import ship

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ADDED = [("ids", "array<int>", pa.list_(pa.int32())), ("n_tokens", "bigint", pa.int64()),
         ("n_byte_tokens", "bigint", pa.int64()), ("decoded", "string", pa.string()),
         ("round_trip", "boolean", pa.bool_()), ("parity", "boolean", pa.bool_())]


def _encode(data: bytes, decoded: bool, parity: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = sentencepiece_model.Codec(data, parity=parity)
        for b in blocks(batches):
            rows = b.rows
            texts = rows.column(rows.schema.get_field_index("text"))
            null = texts.is_null().to_numpy(zero_copy_only=False)
            plain = [t or "" for t in texts.to_pylist()]
            out = codec.encode_all(plain)
            # a list whose start is masked is null
            starts = pa.array(out.offsets.astype(np.int32), mask=np.append(null, False))
            made = {
                "ids": pa.ListArray.from_arrays(starts, pa.array(out.ids)),
                "n_tokens": np.diff(out.offsets), "n_byte_tokens": out.n_byte,
                "decoded": [None if z or not decoded else x.decode("utf-8", "replace") for x, z in zip(out.decoded, null)],
                "round_trip": [x == t.encode() for x, t in zip(out.decoded, plain)], "parity": out.same,
            }
            names = [c for c in rows.schema.names if c not in made]
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(rows.schema.get_field_index(c)) for c in names), *(made[c] if c == "ids" else pa.array(made[c], kind) for c, _, kind in ADDED)],
                names=[*names, *(c for c, _, _ in ADDED)])

    return encode


def encode(docs: DataFrame, model_path: str = MODEL, decoded: bool = True, parity: bool = True) -> DataFrame:
    """``docs`` plus ids, n_tokens, n_byte_tokens, decoded, round_trip (decoded equals text) and parity (ids equal
    the sentencepiece library's; null unless asked for)."""
    ship(docs.sparkSession)
    own = [f for f in docs.schema if f.name not in {c for c, _, _ in ADDED}]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in own] + [f"{c} {kind}" for c, kind, _ in ADDED])
    data = sentencepiece_model.read(model_path)
    return docs.select(*[f.name for f in own]).mapInArrow(_encode(data, decoded, parity), schema)


def decode(rows: DataFrame, model_path: str = MODEL) -> DataFrame:
    """``rows`` (with ``ids``) plus ``decoded``: the texts of the ids."""
    ship(rows.sparkSession)
    data = sentencepiece_model.read(model_path)
    own = [f for f in rows.schema if f.name != "decoded"]

    def undo(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = sentencepiece_model.Codec(data)
        for b in batches:
            lists = b.column(b.schema.get_field_index("ids")).to_pylist()
            texts = [None if x is None else codec.decode([x])[0] for x in lists]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, "decoded"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in own] + ["decoded string"])
    return rows.select(*[f.name for f in own]).mapInArrow(undo, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op10: ids of every document, with round trip and parity verified on each."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = encode(docs, decoded=False)
    return out.select("doc_id", "n_tokens", "n_byte_tokens", "round_trip", "parity", "ids")
