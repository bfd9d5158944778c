"""Packing by concatenating and cutting.

All documents' ids stand in one long row, each document closed by an end id, and windows of fixed
length are cut from it, so only the last one can be short. Two passes give every id its place:
the first writes each document's ids with its start in its partition, the second adds the prefix
sum over the partitions' totals (one number per partition). A document that crosses a window's
edge is cut there; its parts are boundary records of both windows.

The order is that in which the partitions' rows are read; the first pass is written as a table,
so it is fixed from then on and a lost executor repeats only its own partitions.

Defined results: a null or empty text is its end id alone; repeated rows are packed each;
texts are never cut short; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import importlib
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signpost.llm.tables import materialize

WINDOW = 1024
END = 0
# Rows worked on at once: ids of a whole Arrow batch would be held several times over.
_SLICE = 512
_ENCODERS: dict[str, object] = {}


def public_tokenizer(name: str) -> str:
    """The path of a public tokenizer's file on this machine, as installed on the workers."""
    return importlib.import_module("public_tokenizers").path(name)


def _encoder(name: str):
    """A function from texts to the ids that the vocabulary file `name` gives them.

    The file's merges are run by a faster library that gives the same ids; the strings of the
    file's added tokens stand for these, none is added around a text.
    """
    if name not in _ENCODERS:
        import tiktoken

        vocabulary = json.load(open(public_tokenizer(name), encoding="utf-8"))
        special = {t["content"]: t["id"] for t in vocabulary.get("added_tokens", [])}
        back = {c: b for b, c in _byte_characters().items()}
        ranks = {
            bytes(back[c] for c in token): i for token, i in vocabulary["model"]["vocab"].items() if token not in special
        }
        pattern = importlib.import_module("public_tokenizers").PATTERN
        encoding = tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

        def encode(text: str) -> list[int]:
            if any(token in text for token in special):
                return encoding.encode(text, allowed_special="all")
            return encoding.encode_ordinary(text)

        _ENCODERS[name] = encode
    return _ENCODERS[name]


def _byte_characters() -> dict[int, str]:
    """The printable stand-ins of bytes in byte-level vocabularies: those not printable come after 255."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in order, a few at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, _SLICE):
            yield batch.slice(at, _SLICE)


def encoded(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end: int = END) -> DataFrame:
    """doc_id, part, start (in its partition), tokens (with the end id), ids (little-endian uint32)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_text = _encoder(tokenizer)
        part, start = TaskContext.get().partitionId(), 0
        for batch in _slices(batches):
            starts, counts, ids = [], [], []
            for text in batch.column("text"):
                row = np.array([*encode_text(text.as_py() or ""), end], "<u4")
                starts.append(start)
                counts.append(len(row))
                ids.append(row.tobytes())
                start += len(row)
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array([part] * len(ids), pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                ["doc_id", "part", "start", "tokens", "ids"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        encode, f"doc_id {kind}, part int, start bigint, tokens bigint, ids binary"
    )


def placed(tokens: DataFrame) -> DataFrame:
    """The rows of `encoded` with `place`, their start among all ids.

    The window runs over one row per partition of the first pass.
    """
    totals = tokens.groupBy("part").agg(F.sum("tokens").alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    return tokens.join(F.broadcast(bases), "part").withColumn("place", F.col("base") + F.col("start"))


def pieces(docs: DataFrame, window: int = WINDOW, tokenizer: str = "byte_bpe_50k.json", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    `with_ids` adds the piece's ids. Sequences are numbered from 0, offsets are gapless from 0.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows, starts, lengths, sums, parts = [], [], [], [], []
            places = batch.column("place").to_pylist()
            for k, ids in enumerate(batch.column("ids")):
                ids = memoryview(ids.as_buffer())
                count, at = len(ids) // 4, 0
                while at < count:
                    length = min(window - (places[k] + at) % window, count - at)
                    piece = ids[4 * at : 4 * (at + length)]
                    rows.append(k)
                    starts.append(at)
                    lengths.append(length)
                    sums.append(zlib.crc32(piece))
                    if with_ids:
                        parts.append(np.frombuffer(piece, "<u4").astype(np.int32))
                    at += length
            taken = pa.array(rows, pa.int32())
            place = np.asarray(batch.column("place"))[rows] + np.array(starts, np.int64) if rows else np.empty(0, np.int64)
            columns = [
                batch.column("doc_id").take(taken),
                pa.array(starts, pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(sums, pa.int64()),
                batch.column("tokens").take(taken),
                pa.array(place // window, pa.int64()),
                pa.array(place % window, pa.int64()),
            ]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                columns.append(pa.array(parts, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.record_batch(columns, names)

    schema = (
        f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    )
    tokens = materialize(encoded(docs, tokenizer), "pack-ids")
    rows = placed(tokens).select("doc_id", "place", "tokens", "ids")
    return rows.mapInArrow(cut, schema + (", ids array<int>" if with_ids else ""))


def sequences(docs: DataFrame, window: int = WINDOW, tokenizer: str = "byte_bpe_50k.json", pad: int = END) -> DataFrame:
    """The packed sequences: sequence_id, length, ids; padded to `window` unless at a power of two."""
    parts = pieces(docs, window, tokenizer, with_ids=True)
    joined = (
        parts.groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"), F.sum("length").alias("length"))
        .withColumn("ids", F.flatten(F.col("parts.ids")))
    )
    whole = F.col("length").cast("int")
    at_power = whole.bitwiseAND(whole - 1) == 0
    return joined.select(
        "sequence_id",
        "length",
        F.when(at_power, F.col("ids")).otherwise(F.concat("ids", F.array_repeat(F.lit(pad), window - whole))).alias("ids"),
    )
