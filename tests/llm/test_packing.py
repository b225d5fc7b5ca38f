import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from registrylake.llm import packing

WORD = public_tokenizers.path("word_bpe_49k.json")


def test_hilbert_curve_steps_are_one_apart():
    for bits, dims in ((3, 2), (2, 4)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
        keys = packing.hilbert_key(grid, bits)
        assert sorted(keys.tolist()) == list(range(len(grid)))
        path = grid[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_sequence_lengths():
    assert list(packing.sequence_lengths(2048 * 2 + 1027, 2048)) == [2048, 2048, 1024, 2, 1]
    assert list(packing.sequence_lengths(0, 2048)) == []


def check(rows, docs):
    tok = Tokenizer.from_file(WORD)
    want = defaultdict(list)
    for i, t in docs:
        want[i].append(tok.encode(t or "", add_special_tokens=False).ids + [1])
    seqs = defaultdict(list)
    for r in rows:
        ids = want[r.doc_id][0]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
        seqs[r.sequence_id].append((r.offset, r.length))
    for spans in seqs.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= 2048 and at & (at - 1) == 0  # nothing is padded
    for i, all_ids in want.items():
        spans = sorted((r.start, r.length) for r in rows if r.doc_id == i)
        assert sum(n for _, n in spans) == sum(map(len, all_ids))
        if len(all_ids) == 1:
            at = 0
            for start, n in spans:
                assert start == at
                at += n


def test_every_id_once(docs_of, odd_rows):
    check(packing.packed_rows(docs_of(odd_rows, "key")).collect(), odd_rows)


def test_empty_table(docs_of):
    assert packing.packed_rows(docs_of([])).collect() == []


def test_like_documents_are_neighbours():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 49000, 400), rng.integers(0, 49000, 400)
    near = a.copy()
    near[:8] = rng.integers(0, 49000, 8)
    pa_, pn, pb = map(packing.curve_point, (a, near, b))
    assert np.linalg.norm(pa_ - pn) < np.linalg.norm(pa_ - pb)
