import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from registrylake.llm import records
from registrylake.llm.common import scratch
from registrylake.llm.encode import PieceEncoder, encoder

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def plain(path, text):
    tok = Tokenizer.from_file(path)
    return tok.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
@settings(max_examples=150, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sa.Zé!1  \x1c"), st.characters(codec="utf-8")), max_size=60))
def test_pieces_equal_whole_text(path, text):
    enc = encoder(path)
    assert np.frombuffer(enc.encode([text])[0], enc.dtype).tolist() == plain(path, text)


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_literals_of_special_tokens(path):
    enc = encoder(path)
    for text in ("a <|endoftext|> b", "<|endoftext|>", "x<|startoftext|>y\nword", "<|ENDOFTEXT|> <|endoftext |>", "plain words"):
        for _ in range(2):
            assert np.frombuffer(enc.encode([text, "plain <| words"])[0], enc.dtype).tolist() == plain(path, text)
    assert 50256 in plain(BYTE, "a <|endoftext|> b") and 49407 in plain(WORD, "a <|endoftext|> b")


def test_memory_is_bounded():
    enc = PieceEncoder(WORD, remembered=5)
    for i in range(20):
        enc.encode([f"w{i} x{i} y{i}"])
    assert len(enc.known) <= 5 + 3 and len(enc.older) <= 5 + 3
    assert np.frombuffer(enc.encode(['w0 x1 w19'])[0], enc.dtype).tolist() == plain(WORD, 'w0 x1 w19')


def test_round_trip(spark, docs_of, odd_rows):
    manifest = records.write_records(docs_of(odd_rows, "start"), scratch(spark, "t"), BYTE)
    got = sorted(map(tuple, records.read_records(spark, manifest).collect()), key=lambda r: r[1])
    want, at = [], 0
    for doc_id, text in sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = plain(BYTE, text or "") + [0]
        want.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want


def test_a_shared_doc_id_spans_shards(spark, docs_of):
    rows = [(7 if i % 2 else None, f"text number {i} " * 20) for i in range(600)]
    manifest = records.write_records(docs_of(rows), scratch(spark, "t"), BYTE, shard_bytes=2000)
    got = sorted(map(tuple, records.read_records(spark, manifest).collect()), key=lambda r: r[1])
    assert len(got) == 600 and [r[0] for r in got] == [None] * 300 + [7] * 300
    assert max(m.n_docs for m in manifest) < 120
    assert all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:]))


def test_reads_and_shards_are_bounded_by_bytes(spark, docs_of, monkeypatch):
    rows = [(i, "some words " * (i % 50)) for i in range(400)]
    manifest = records.write_records(docs_of(rows), scratch(spark, "t"), BYTE, shard_bytes=4000)
    assert len(manifest) > 16 and all(m.n_tokens < 4000 for m in manifest)
    whole = sorted(map(tuple, records.read_records(spark, manifest).collect()))
    monkeypatch.setattr(records, "READ_BYTES", 300)
    assert sorted(map(tuple, records.read_records(spark, manifest).collect())) == whole and [r[0] for r in whole] == list(range(400))


def test_empty_table(spark, docs_of):
    manifest = records.write_records(docs_of([]), scratch(spark, "t"), BYTE)
    assert records.read_records(spark, manifest).collect() == []


def test_damage_is_found():
    data = bytearray(records.frame(7, b"\x01\x00\x02\x00"))
    assert records.unframe(bytes(data), 0) == (7, b"\x01\x00\x02\x00", len(data))
    for at in range(len(data)):
        bad = bytearray(data)
        bad[at] ^= 1
        with pytest.raises((ValueError, struct.error)):
            records.unframe(bytes(bad), 0)
    index = records.pack_index([0, 20], [1, 2])
    assert [x.tolist() for x in records.unpack_index(index)] == [[0, 20], [1, 2]]
    with pytest.raises(ValueError):
        records.unpack_index(index[:9] + b"\x09" + index[10:])
