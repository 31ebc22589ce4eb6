import itertools
import math
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from fiscalake.llm import likelihood

from .cases import documents, frame

PATH = public_tokenizers.path("piece_bpe_32k.model")


def spelled(word, lattice):
    """The probability of a word by going through all its segmentations."""
    text = "▁" + word
    total = 0.0
    for cuts in itertools.product((0, 1), repeat=len(text) - 1):
        ends = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(text)]
        p = 1.0
        for a, b in zip(ends, ends[1:]):
            part = text[a:b]
            if part in lattice.pieces:
                p *= math.exp(lattice.pieces[part])
            elif len(part) == 1:
                p *= math.exp(sum(lattice.bytes[x] for x in part.encode()))
            else:
                p = 0.0
        total += p
    return math.log(total)


def test_marginal_is_the_sum_over_segmentations():
    lattice = likelihood.Lattice(PATH, {5000: 10, 300: 100})
    for word in ("the", "nation", "éz", "\U00013000a", "xx", "1"):
        assert lattice.word(word.encode()) == pytest.approx(spelled(word, lattice))
    assert sum(map(math.exp, [*lattice.pieces.values(), *lattice.bytes.values(), lattice.end])) == pytest.approx(1)


@pytest.mark.parametrize("head", [1 << 17, 4])
def test_against_brute_force(spark, monkeypatch, head):
    """Once with all words in the head, once with nearly all in the tail."""
    monkeypatch.setattr(likelihood, "HEAD", head)
    rows = documents()
    got = likelihood.log_likelihood(frame(spark, rows), PATH, F.col("doc_id") % 10 != 0).collect()
    words = lambda t: [*(t or "").encode().lower().split(), b""]
    count = Counter(w for i, t, *_ in rows if i is not None and i % 10 for w in words(t))
    n, v = sum(count.values()), len(count)
    model = likelihood.vocabulary(PATH)
    pieces = Counter()
    for w, c in count.items():
        for p in model.encode(w.decode()) if w else [model.eos_id()]:
            pieces[p] += c
    lattice = likelihood.Lattice(PATH, dict(pieces))
    want = []
    for i, t, *_ in rows:
        base = sum(math.log10((count.get(w, 0) + 0.1) / (n + 0.1 * (v + 1))) for w in words(t))
        score = sum(map(lattice.word, words(t))) / math.log(10)
        want.append((i, len(words(t)), sum(w in count for w in words(t)), n, round(base, 6), round(score, 6)))
    found = [(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in got]
    assert sorted(map(repr, found)) == sorted(map(repr, want))


def test_nothing_to_learn_and_nothing_to_score(spark):
    df = frame(spark, documents(size=6), clash=False)
    got = likelihood.log_likelihood(df, PATH, F.lit(False)).collect()
    assert len(got) == 18 and all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["score"] < 0 for r in got)
    assert likelihood.log_likelihood(df.limit(0), PATH, F.lit(True)).collect() == []
