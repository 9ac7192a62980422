import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from obralake.llm.differencing import deal, difference
from obralake.llm.packing import WordEncoder, pack, windows
from obralake.llm.sharding import shard

from .common import crc, documents, prose

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", "a  b", "x \n\n y", "\n a", "a ", "é ü  z", "don't <|endoftext|> we'll", "ab   c"]


def rows():
    return [(i, t) for i, t in enumerate(ODD)] + [(20, None), (21, prose(1, 4000)), (22, prose(2, 50)),
            (22, prose(2, 50)), (None, "no id"), (23, "one " * 9000), *[(100 + i, prose(i, 30 + i)) for i in range(80)]]


def test_differencing_is_a_partition_of_nearly_equal_loads():
    sizes = np.random.default_rng(1).integers(1, 1000, 500)
    lanes = deal(sizes, 7)
    loads = np.bincount(lanes, sizes, 7)
    assert loads.sum() == sizes.sum() and loads.max() - loads.min() <= 2
    parts = np.array([[5, 0, 3], [4, 4, 0], [1, 9, 2]])
    to = difference(parts)
    assert all(sorted(r) == [0, 1, 2] for r in to)
    assert difference(np.zeros((0, 3), int)).shape == (0, 3)


def test_windows_never_overflow():
    lengths = np.array([700] * 10 + [2048, 1])
    lane = windows(lengths, 2048)
    assert np.bincount(lane, lengths).max() <= 2048


def test_ids_are_those_of_the_tokenizer():
    real, encoder = Tokenizer.from_file(VOCABULARY), WordEncoder(VOCABULARY)
    rng = random.Random(2)
    bits = [" ", "  ", "\n", "\t", "\r\n", "\u00a0", "\u3000", "\u2028", "<|endoftext|>", "<|endof", "a", "Zoë", "12",
            "3.5", "'s", "'re", "’", "日本", "😀", "e\u0301", "\x00", "\x1c", "...", "$", "_", "I'll", "ß"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == real.encode(text, add_special_tokens=False).ids, text


def test_every_id_is_in_one_piece(spark):
    got = pack(documents(spark, rows()).repartition(3), VOCABULARY, block=64).collect()
    real = Tokenizer.from_file(VOCABULARY)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        assert r.length == len(r.input_ids) // 4
    for i, text in rows():
        want = real.encode(text or "", add_special_tokens=False).ids + [1]
        copies = sum(j == i for j, _ in rows())
        parts = sorted(by_doc[i], key=lambda r: r.start)
        assert sum(r.length for r in parts) == copies * len(want)
        assert all(r.doc_tokens == len(want) for r in parts)
        for r in parts:
            assert np.frombuffer(r.input_ids, "<u4").tolist() == want[r.start:r.start + r.length]
    total = 0
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r.offset)
        at = 0
        for r in parts:
            assert r.offset == at
            at += r.length
        assert at <= 2048
        total += at
    assert total >= 0.8 * 2048 * len(by_sequence)


def test_shards_are_balanced_and_keep_copies_together(spark):
    data = rows() + [(500 + i, "copy") for i in range(300)]
    got = shard(documents(spark, data), 5).collect()
    assert len(got) == len(data)
    text = {}
    for i, t in data:
        text.setdefault(i, t or "")
    place, slots, loads = defaultdict(set), defaultdict(list), defaultdict(int)
    for r in got:
        t = text[r.doc_id]
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(t.encode()) + 16, crc(t), "bytes", None)
        place[t].add(r.shard)
        slots[r.shard].append(r.slot)
        loads[r.shard] += r.size
    assert all(len(v) == 1 for v in place.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(len((t or "").encode()) + 16 for _, t in data)
    assert max(loads.values()) <= max(largest, sum(loads.values()) / 5 * 1.3)


@pytest.mark.parametrize("blocks", [40, 10])
def test_shards_of_many_blocks(spark, monkeypatch, blocks):
    from obralake.llm import sharding
    monkeypatch.setattr(sharding, "BLOCK", blocks)
    monkeypatch.setattr(sharding, "MERGED", 3)
    got = shard(documents(spark, [(i, prose(i, 20 + i % 90)) for i in range(300)]), 4).collect()
    loads = defaultdict(int)
    for r in got:
        loads[r.shard] += r.size
    assert len(loads) == 4 and max(loads.values()) - min(loads.values()) < 0.01 * sum(loads.values())


def test_empty_tables(spark):
    none = documents(spark, [])
    assert pack(none, VOCABULARY).collect() == []
    assert shard(none, 4).collect() == []
