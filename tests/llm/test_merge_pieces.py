import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from fiscalake.llm import merge_pieces
from fiscalake.llm.merge_pieces import MergePieces

from .cases import documents, frame

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def pieces():
    return MergePieces(PATH)


def merged(pieces, text):
    """Merging as it is defined: the best pair, the left one of equals, until there is none."""
    parts = list(text)
    while True:
        scores = [pieces.score.get(a + b, -np.inf) for a, b in zip(parts, parts[1:])]
        if not scores or max(scores) == -np.inf:
            return parts
        at = scores.index(max(scores))
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


def texts(n=4000):
    rng = random.Random(5)
    parts = ["a", "b", "the", "▁", " ", "  ", "\n", "\t", "é", "漢", "😀", "́", "x", "1", "00", "\0", "<s>", "<0x0A>", "ing", "�", "\r"]
    yield from ("".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(n))
    for n in range(60):
        yield from (" " * n, " " * n + "a", "a" + " " * n + "b", "=" * n, "0" * n, "ab" * n, "\n" * n)


def test_ids_and_texts_are_those_of_the_library(pieces, library):
    for text in texts():
        ids = pieces.encode(text.encode())
        assert ids.tolist() == library.encode(text), text
        assert pieces.decode(ids).decode() == library.decode(ids.tolist()), text


def test_any_ids_decode_as_in_the_library(pieces, library):
    rng = random.Random(7)
    for _ in range(5000):
        kinds = [0, 1, 2, rng.randrange(3, 259), rng.randrange(195, 259), rng.randrange(259, 32000), 259, 29871]
        ids = rng.choices(kinds, k=rng.randint(0, 8))
        assert pieces.decode(np.array(ids, np.int64)).decode() == library.decode(ids), ids


def test_pairs_and_prefixes_against_plain_merging(pieces):
    rng = random.Random(3)
    tokens = rng.sample(range(len(pieces.texts)), 300) + list(range(40))
    for _ in range(20_000):
        a, b = rng.choice(tokens), rng.choice(tokens)
        own = all(merged(pieces, pieces.texts[t]) == [pieces.texts[t]] for t in (a, b))
        pair = merged(pieces, pieces.texts[a] + pieces.texts[b]) == [pieces.texts[a], pieces.texts[b]]
        assert pieces.compatible(a, b) == (own and pair)
    for text in texts(200):
        text = text.replace(" ", "▁")
        last = pieces.last_tokens(text)
        for n in range(1, len(text) + 1):
            expected = merged(pieces, text[:n])[-1]
            assert (text[n - 1] if last[n] < 0 else pieces.texts[last[n]]) == expected
            # Only one token that ends here is compatible with the prefix before it.
            ending = [t for end, t in pieces.automaton.iter(text[:n]) if end == n - 1]
            assert sum(pieces.compatible(last[n - pieces.length[t]], t) for t in ending) == (last[n] >= 0)


def test_a_worker_forgets_parts(library, monkeypatch):
    monkeypatch.setattr(merge_pieces, "HELD", 2000)
    monkeypatch.setattr(merge_pieces, "PAIRS", 50)
    small = MergePieces(PATH)
    for text in ["some words here", "more words " * 50, "x" * 5000, "none of the above"] * 3:
        assert small.encode(text.encode()).tolist() == library.encode(text)
        assert small.weight < 2000 + 30 * 5000
    forgotten = 0
    for i in range(60):
        text = f"often found words {i} and {i * i} new {chr(97 + i % 26) * i}"
        before = small.held
        assert small.encode(text.encode()).tolist() == library.encode(text)
        forgotten += small.held < before
        # What is in text after text is kept when the rest goes.
        assert forgotten < 2 or small.words.ids[b" often"] < 8
        assert len(small.words.ids) == small.held <= small.weight
    assert forgotten > 3


def test_tables(spark, library):
    rows = documents() + [(200, "no blanks" * 30_000, "en", None), (201, "é漢\n" * 9000, None, "a")]
    ids = merge_pieces.encoded(frame(spark, rows), PATH, keep=("doc_id", "lang"))
    expected = sorted([(i, y, library.encode(t or "")) for i, t, y, _ in rows], key=repr)
    assert sorted(map(tuple, ids.collect()), key=repr) == expected
    back = merge_pieces.decoded(ids, PATH)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted([(i, t or "") for i, t, _, _ in rows], key=repr)
    nothing = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert sorted(map(tuple, merge_pieces.decoded(nothing, PATH).collect())) == [(1, ""), (2, "")]
    assert merge_pieces.encoded(frame(spark, []), PATH).collect() == []


def test_query(spark, library, tmp_path):
    rows = [r for r in documents() if r[0] is not None]
    frame(spark, rows, clash=False).write.parquet(str(tmp_path / "documents.parquet"))
    got = merge_pieces.op11_pieces(spark, str(tmp_path)).collect()

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    expected = []
    for i, text, _, _ in rows:
        ids = library.encode(text or "")
        expected.append((i, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids))))
    assert sorted(map(tuple, got)) == sorted(expected)


def test_a_vocabulary_that_merges_otherwise_is_refused(monkeypatch):
    monkeypatch.setattr(MergePieces, "compatible", lambda self, left, right: self._merged(right) is not None)
    with pytest.raises(ValueError, match="not a vocabulary of merges"):
        MergePieces(PATH)
