"""Packing against the tokenizer itself."""

import struct
import zlib

import pytest
from signpost.llm import packing
from signpost.llm.queries import QUERIES

KIND = "doc_id long, text string, part int"


@pytest.fixture(scope="module")
def ids():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.public_tokenizer("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def check(rows, documents, ids, window):
    """`documents` is a list of (doc_id, text)."""
    want = {}
    for d, text in documents:
        want.setdefault(d, []).append(ids(text))
    whole, sequences = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        whole.setdefault(r.doc_id, []).append(r)
    assert set(whole) == set(want)
    for d, parts in whole.items():
        if len(want[d]) == 1:
            at = 0
            for r in sorted(parts, key=lambda r: r.start):
                piece = want[d][0][at : at + r.length]
                assert r.start == at and r.doc_tokens == len(want[d][0])
                assert zlib.crc32(struct.pack(f"<{len(piece)}I", *piece)) == r.ids_crc32
                at += r.length
            assert at == len(want[d][0])
    total = sum(len(i) for v in want.values() for i in v)
    assert sorted(sequences) == list(range(-(-total // window)))
    for number, parts in sequences.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == (window if number < total // window else total % window)


def test_pieces(spark, ids):
    texts = ["Hello <|endoftext|> world", "<|endoftext|><|endoftext|>x <|endof", None, "", "été 中文 \U0001f600\n\n  x", "a" * 5000, "one two " * 3000, "\xa0\t"]
    rows = list(enumerate(texts)) + [(50, "same"), (50, "same"), (None, "no id")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], KIND).repartition(4)
    check(packing.pieces(frame, window=64).collect(), rows, ids, 64)


def test_sequences(spark, ids):
    frame = spark.createDataFrame([(1, "some words to be packed", 1), (2, "more", 1), (3, None, 1)], KIND)
    flat = sum((ids(t) for t in ("some words to be packed", "more", None)), [])
    rows = sorted(packing.sequences(frame.coalesce(1), window=6).collect())
    joined = [i for r in rows for i in r.ids[: r.length]]
    assert joined == flat
    for r in rows:
        assert len(r.ids) == (r.length if r.length & (r.length - 1) == 0 else 6)


def test_empty(spark):
    assert packing.pieces(spark.createDataFrame([], KIND)).count() == 0


def test_query(spark, ids):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(QUERIES["op6_pack"](spark, sf).collect(), rows, ids, 1024)


def test_batches_are_worked_on_in_slices():
    import pyarrow as pa

    batches = [pa.record_batch([pa.array(range(n))], ["x"]) for n in (packing._SLICE * 2 + 3, 0, 5)]
    parts = list(packing._slices(iter(batches)))
    assert max(p.num_rows for p in parts) == packing._SLICE
    assert [x for p in parts for x in p.column("x").to_pylist()] == [x for b in batches for x in b.column("x").to_pylist()]
