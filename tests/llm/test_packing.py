import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fiscalake.llm import packing

from .cases import documents, frame

PATH = public_tokenizers.path("byte_bpe_50k.json")


def fewest(sizes, capacity):
    """By trying all ways, for a handful of sizes."""
    best = len(sizes)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + sizes[i] <= capacity:
                place(i + 1, bins[:b] + [bins[b] + sizes[i]] + bins[b + 1 :])
        place(i + 1, bins + [sizes[i]])

    place(0, [])
    return best


def test_plans_are_optimal_for_small_cases():
    rng = random.Random(4)
    for _ in range(150):
        sizes = sorted((rng.randint(1, 30) for _ in range(rng.randint(1, 9))), reverse=True)
        plan = packing.complete(dict(Counter(sizes)), 30)
        assert Counter(s for filling, n in plan for s in filling * n) == Counter(sizes)
        assert all(sum(filling) <= 30 for filling, _ in plan)
        assert sum(n for _, n in plan) == fewest(sizes, 30) >= packing.least(Counter(sizes), 30)


def test_many_pieces_of_one_token():
    counts = {700: 30, 1: 1000}
    plan = packing.complete(counts, 2048)
    assert Counter(s for filling, n in plan for s in filling * n) == counts
    assert all(sum(filling) <= 2048 for filling, _ in plan)


def test_cut():
    assert packing.cut(1, 4) == [(0, 1)]
    assert packing.cut(4, 4) == [(0, 4)]
    assert packing.cut(9, 4) == [(0, 1), (1, 4), (5, 4)]
    assert packing.cut(8, 4) == [(0, 4), (4, 4)]


def test_round_trip(spark):
    rows = documents() + [(200, "a <|endoftext|> b", "en", None)]
    got = packing.pack(frame(spark, rows), PATH).collect()
    plain = Tokenizer.from_file(PATH)
    want = Counter()
    for i, text, _, _ in rows:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 2048 or 2048
        starts = [0, *range(first, len(ids), 2048)]
        for n, (a, b) in enumerate(itertools.zip_longest(starts, starts[1:], fillvalue=len(ids))):
            want[(i, n, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) == packing.least(Counter(n for p in sequences.values() for _, n in p), 2048)


@pytest.mark.parametrize("rows", [[], [(None, None, None, None)]])
def test_nothing_to_pack(spark, rows):
    got = packing.pack(frame(spark, rows, clash=False), PATH).collect()
    assert [(r["piece"], r["length"], r["offset"]) for r in got] == [(0, 1, 0)] * len(rows)
