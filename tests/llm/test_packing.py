from __future__ import annotations

from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from awkward import empty, frame, texts
from tokenizers import Tokenizer

from tidemark.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 2), (4, 2)])
def test_hilbert_visits_every_point_by_single_steps(dims, bits):
    grid = np.array(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij")).reshape(dims, -1).T
    number = packing.hilbert(grid, bits)
    assert sorted(number) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(number)], axis=0)).sum(axis=1) == 1).all()


def test_round_trip_of_all_ids_without_gaps(spark):
    rows = texts()
    got = packing.pack(frame(spark), PATH, length=256).collect()
    tokenizer = Tokenizer.from_file(PATH)
    pieces = defaultdict(list)
    for p in got:
        pieces[p.doc_id].append(p)
    expected = defaultdict(list)
    for i, text, _ in rows:
        expected[i].append([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1])
    for i, lists in expected.items():
        starts = defaultdict(list)
        for p in pieces[i]:
            ids = np.frombuffer(p.ids, "<u4").tolist()
            assert len(ids) == p.length
            assert any(p.doc_tokens == len(one) and one[p.start:p.start + p.length] == ids for one in lists)
            starts[p.doc_tokens].append(p.length)
        assert sum(sum(v) for v in starts.values()) == sum(map(len, lists))
    sequences = defaultdict(list)
    for p in got:
        sequences[p.sequence_id].append((p.offset, p.length))
    for seq, parts in sequences.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 256 or seq == max(sequences)


def test_copies_stand_side_by_side(spark):
    rows = [(i, f"alpha beta gamma {'delta' if i % 2 else 'omega ' * 30}", "s") for i in range(40)]
    got = sorted(packing.pack(frame(spark, rows), PATH).collect(), key=lambda p: (p.sequence_id, p.offset))
    kinds = [p.doc_id % 2 for p in got]
    assert sum(a != b for a, b in zip(kinds, kinds[1:])) == 1


def test_empty_table(spark):
    assert packing.pack(empty(spark), PATH).collect() == []
