"""Jaccard join and removal of repeated passages against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fiscalake.llm import jaccard, suffixes

from .cases import documents, frame, prose


def components(rows):
    sets = []
    for _, text, *_ in rows:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    pairs = Counter((a, b) for members in where.values() for a in members for b in members if a < b)
    for (a, b), common in pairs.items():
        if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
            parent[find(b)] = find(a)
    smallest = defaultdict(list)
    for i, row in enumerate(rows):
        if row[0] is not None:
            smallest[find(i)].append(row[0])
    return Counter((rows[i][0], len(s), min(smallest[find(i)], default=None) if s else rows[i][0]) for i, s in enumerate(sets))


def family(rng, first, size, words, changes):
    """Copies of one text, each changed in some places: links inside, also by chains."""
    base = prose(rng, words).split()
    out = []
    for i in range(size):
        text = list(base)
        for _ in range(rng.randint(0, changes)):
            text[rng.randrange(words)] = f"w{rng.randrange(50)}"
        out.append((first + i, " ".join(text), "en", "s"))
    return out


@pytest.mark.parametrize("leaders", [(1, 8), ()])
def test_join_against_brute_force(spark, monkeypatch, leaders):
    """Once as it is, once without leaders, so that the last round finds all links."""
    monkeypatch.setattr(jaccard, "LEADERS", leaders)
    rng = random.Random(11)
    rows = documents() + family(rng, 1000, 25, 80, 5) + family(rng, 2000, 10, 30, 2)
    rows += [(3000, "A b C", None, None), (3001, "a B c", None, None), (3002, "a b", None, None)]
    got = jaccard.join_texts(frame(spark, rows))
    assert Counter(map(tuple, got.collect())) == components(rows)


@pytest.mark.parametrize("opening", [0, 10])
def test_links_at_the_least_overlap(spark, opening):
    """Pairs of 24 and 25 shingles with 22 in common, and of 49 and 50 with 44; once with an
    opening that all texts have, whose shingles come last in every order."""
    rng = random.Random(15)
    new = lambda n: [f"x{rng.randrange(10**9)}" for _ in range(n)]
    first, rows = new(opening), []
    for i in range(400):
        shared, more = (26, 2) if i % 2 else (48, 5)
        both = first + new(shared - opening)
        rows += [(2 * i, " ".join(both + new(more)), None, None), (2 * i + 1, " ".join(both + new(more + 1)), None, None)]
    got = jaccard.join_texts(frame(spark, rows))
    assert Counter(map(tuple, got.collect())) == components(rows)


def test_frequent_shingles_are_counted_over_all_texts(spark):
    """Nine of 120,000 texts share an opening: its shingle comes last, under any order."""
    own = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(30)), lambda i: F.concat(F.lit("w"), F.col("id"), F.lit("x"), i)), " ")
    opening = F.when(F.col("id") % 13_500 == 7, "all of these begin alike ").otherwise("")
    hot = jaccard._frequent(spark.range(120_000).select(F.col("id").cast("string").cast("binary").alias("key"), F.concat(opening, own).alias("text")))
    shared = int(jaccard.Shingles().of(b"all of these begin alike")[0])
    for i in range(7, 120_000, 13_500):
        codes = jaccard.Shingles().of(("all of these begin alike " + " ".join(f"w{i}x{j}" for j in range(31))).encode())
        assert shared in codes.tolist()
        assert not any(shared in jaccard.firsts(codes, hot, seed).tolist() for seed in range(20))


def test_shared_firsts_asked_for_are_guaranteed(spark):
    sizes = [(n, m) for n in range(1, 260) for m in range(n, 5 * n // 4 + 1)]
    behind = lambda n: n - min(n, n - jaccard.needed(n) + jaccard.spare(n))
    asked = spark.createDataFrame(sizes, "n long, m long").select("n", "m", jaccard._enough("n", "m"), jaccard._enough("m", "n"))
    for n, m, one, other in asked.collect():
        assert one == other == max(1, -(-4 * (n + m) // 9) - max(behind(n), behind(m)))


def test_one_of_each(spark):
    rows = documents(size=30)
    want = components(rows)
    kept = jaccard.one_of_each(frame(spark, rows, clash=False)).collect()
    firsts = {c for _, n, c in want if n}
    assert sorted(r["doc_id"] for r in kept if r["text"] and r["text"].split()) == sorted(firsts)
    assert {r["text"] for r in kept if not (r["text"] or "").split()} == {None, "", " \t\n "}


def without(rows):
    texts = [(t or "").encode() for _, t, *_ in rows]
    count = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    out = []
    for row, t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - 199):
            if count[t[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((row[0], len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("many, batch", [(4096, 1 << 20), (1, 500)])
def test_passages_against_brute_force(spark, monkeypatch, many, batch):
    """Once as it is, once with every anchor dealt by its surroundings."""
    monkeypatch.setattr(suffixes, "MANY", many)
    rng = random.Random(12)
    shared = prose(rng, 80)
    rows = documents()
    rows += [(500 + i, f"{prose(rng, 6)}{shared[i * 3 : 230 + i * 5]}{prose(rng, 5)}", None, None) for i in range(25)]
    rows += [(600, "xy" * 300, None, None), (601, "z" + "xy" * 150, None, None), (602, "q" * 199, None, None), (603, "q" * 200, None, None), (604, "q" * 201, None, None)]
    rows += [(700, prose(rng, 50) + "ü" * 150, None, None), (701, "ü" * 120 + prose(rng, 50), None, None)]
    got = suffixes.without_repeats(frame(spark, rows))
    assert Counter(map(tuple, got.collect())) == without(rows)


def test_no_documents(spark):
    none = frame(spark, [], clash=False)
    assert jaccard.join_texts(none).collect() == []
    assert suffixes.without_repeats(none, with_text=True).collect() == []


def test_levels_merge_geometrically():
    rng = random.Random(13)
    pieces = [prose(rng, 60).encode()[:260] for _ in range(40)]
    once, more = suffixes.Family(), suffixes.Family()
    once.add(pieces * 2)
    for p in pieces * 2:
        more.add([p])
    assert (once.twice[: once.used] == more.twice[: more.used]).all() and once.twice.any()
    sizes = [len(p) for p, _ in more.levels]
    assert len(sizes) <= 7 and all(a >= 2 * b for a, b in zip(sizes, sizes[1:]))


def test_anchors_depend_on_the_window_alone():
    rng = random.Random(14)
    text = prose(rng, 300).encode()
    for shift in (1, 7, 150):
        whole = {p: a for s, e, a, _ in zip(*suffixes.anchors(text)) for p in range(s, e)}
        part = {p + shift: a + shift for s, e, a, _ in zip(*suffixes.anchors(text[shift:])) for p in range(s, e)}
        assert all(whole[p] == a for p, a in part.items())


def test_parities_tell_no_more_than_the_difference():
    rng = np.random.default_rng(3)
    for n, changed in ((5, 1), (40, 6), (100, 30), (3000, 500), (30, 60)):
        for _ in range(50):
            shared = rng.integers(0, 2**63, n).astype(np.uint64)
            a = np.unique(np.concatenate([shared, rng.integers(0, 2**63, changed).astype(np.uint64)]))
            b = np.unique(np.concatenate([shared, rng.integers(0, 2**63, changed // 2).astype(np.uint64)]))
            apart = sum(int(x).bit_count() for x in (jaccard.parities(a) ^ jaccard.parities(b)).view(np.uint64))
            assert apart <= len(np.setxor1d(a, b))
            if jaccard.linked(a, b):
                assert 9 * apart <= len(a) + len(b)
    assert not jaccard.parities(np.empty(0, np.uint64)).any()


def test_heavily_changed_copies_of_a_family(spark):
    """Copies on both sides of the least similarity, of which some link only to others
    that were changed in the same places."""
    rng = random.Random(21)
    base = prose(rng, 90).split()
    rows = []
    for i in range(260):
        text = list(base)
        for place in rng.sample([5, 20, 35, 50, 65, 80], rng.randint(0, 5)):
            text[place] = f"z{place}{rng.randrange(3)}"
        rows.append((i, " ".join(text), None, None))
    got = jaccard.join_texts(frame(spark, rows))
    assert Counter(map(tuple, got.collect())) == components(rows)
