import itertools
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from fiscalake.llm import fertility, language, toxicity

from .cases import documents, frame, prose

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def varied(rng, n):
    """Prose of some hundred words of many syllables, a few words frequent, as in real texts."""
    syllable = lambda r: r.choice("bcdfghklmnprstvw") + r.choice("aeiou") + r.choice(["", "", "n", "r", "st", "l"])
    words = ["".join(syllable(random.Random(7 * seed + k)) for k in range(1 + seed % 3)) for seed in range(400)]
    words += ["the", "of", "and", "to", "in"] * 12
    return " ".join(rng.choice(words) + rng.choice(["", "", "", "s", ",", "."]) for _ in range(n))


def base(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
        len(words) < 20 or 100 * len(covered) > 30 * len(words),
    )


def test_fertility_against_brute_force(spark):
    import sentencepiece

    rows = documents() + [
        (300, "a b c d e f g h i\na b c d e f g h i\n\n \na b", "en", None),
        (301, "| a # b\n" * 30, "en", None),
        (302, " x y \x0bz\x0c" * 9, "en", None),
        (303, "слово и ещё другие слова " * 2 + prose(random.Random(1), 3), "ru", None),
        (304, " ".join(chr(0x13000 + i) for i in range(300)), None, None),
        *((400 + i, varied(random.Random(i), random.Random(i).randint(30, 400)), "en", None) for i in range(40)),
    ]
    got = fertility.judge_quality(frame(spark, rows), PIECES).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter((r["doc_id"], *(r[n] for n in names)) for r in got) == Counter((i, *base(t)) for i, t, _, _ in rows)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = {i: t for i, t, _, _ in rows}
    for r in got:
        ids = [p for w in WORD.findall(texts[r["doc_id"]] or "") for p in model.encode(w)]
        assert r["n_tokens"] == len(ids) or r["doc_id"] is None
        if ids and r["doc_id"] is not None:
            share = np.array(list(Counter(ids).values())) / len(ids)
            assert r["token_entropy"] == pytest.approx(-(share * np.log2(share)).sum(), abs=1e-9)
            assert r["byte_share"] == pytest.approx(np.mean([model.is_byte(p) for p in ids]))
            assert r["chars_per_token"] == pytest.approx(r["word_chars"] / len(ids))
        assert not (r["base_failed"] and r["kept"])
    assert {r["doc_id"]: r["script"] for r in got}[303] == "cyrillic"
    # Texts of many different words stay; those of nine syllables are told by their entropy.
    assert all(r["kept"] for r in got if (r["doc_id"] or 0) >= 400 and not r["base_failed"])
    for r in got:
        if not r["base_failed"]:
            floor = fertility.BANDS[r["script"]].entropy * np.log2(min(r["n_tokens"], fertility.SPREAD))
            assert (r["reason"] == "entropy") == (r["token_entropy"] < floor) or r["reason"] in ("chars", "bytes")
            assert r["kept"] == (r["reason"] == "")
    assert any(r["reason"] == "entropy" for r in got)
    assert fertility.judge_quality(frame(spark, []), PIECES).collect() == []


def test_bands_from_labels(spark):
    rows = [(i, varied(random.Random(i), 60 + i), "en", None) for i in range(50)]
    rows += [(50, "one word", "en", None), (51, prose(random.Random(1), 90), "en", None), (None, None, None, None)]
    labels = spark.createDataFrame([(i, int(i != 51), 0) for i in [*range(52), 0, 99]], "doc_id long, quality int, toxic int")
    (band,) = fertility.derived_bands(frame(spark, rows), labels, PIECES, margin=0.1).collect()
    figures = [fertility.measures(t.encode(), fertility.Pieces(PIECES)) for _, t, _, _ in rows[:50]]
    bits = [m["token_entropy"] / np.log2(min(m["n_tokens"], fertility.SPREAD)) for m in figures]
    assert (band["script"], band["texts"], band["bytes"]) == ("latin", 50, pytest.approx(0.1))
    assert band["entropy"] == pytest.approx(0.9 * min(bits))
    assert band["least"] == pytest.approx(0.9 * min(m["chars_per_token"] for m in figures))
    assert band["most"] == pytest.approx(1.1 * max(m["chars_per_token"] for m in figures))


def test_bands():
    good = {"n_words": 100, "n_repeat_words": 0, "script": "latin", "chars_per_token": 3.0, "byte_share": 0.0, "n_tokens": 300, "token_entropy": 7.0}
    assert fertility.verdict(good) == ""
    for change, reason in (({"n_words": 19}, "base"), ({"chars_per_token": 1.0}, "chars"), ({"byte_share": 0.3}, "bytes"), ({"token_entropy": 2.0}, "entropy")):
        assert fertility.verdict(good | change) == reason
    assert fertility.verdict(good | {"script": "other", "byte_share": 0.3}) == ""


def test_known_words_are_forgotten_in_time():
    few, many = fertility.Pieces(PIECES, limit=3), fertility.Pieces(PIECES)
    for text in (b"one two three four", b"four five one", b"", b"two two five six seven"):
        assert fertility.measures(text, few) == fertility.measures(text, many)


def test_language_on_held_out_texts(spark):
    rows = documents(size=200)
    df = frame(spark, rows)
    known = frame(spark, [r for r in rows if r[0] is not None and r[0] % 3 != 1])
    model = language.fit(known, language.Settings(sample=150))
    got = language.identify(df, model).collect()
    labels = {i: y for i, _, y, _ in rows}
    judged = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 200]
    assert np.mean([r["lang_pred"] == labels[r["doc_id"]] for r in judged if r["doc_id"] % 3 == 1]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)
    by_id = {r["doc_id"]: r["lang_pred"] for r in got}
    assert all(by_id[i] == "und" for i in (100, 101, 102, 104)) and by_id[103] != "und"
    assert len(got) == len(rows)


def test_language_is_learned_from_every_row(spark):
    """In groups of 40 of 330 rows: a text that one row alone has tells its language, too."""
    rng = random.Random(31)
    rows = [(i, prose(rng, 40, ("en", "fr")[i % 2]), ("en", "fr")[i % 2], "s") for i in range(300)]
    rows += [(300 + i, chr(0x3B1 + i % 24) * 3 + " " + chr(0x430 + i) * 40, "xx", "s") for i in range(30)]
    model = language.fit(frame(spark, rows, clash=False), language.Settings(sample=40))
    assert model.languages == ["en", "fr", "xx"]
    # The small language is dealt to three groups each.
    assert model.texts == (150, 150, 90)
    assert np.mean([language.predict(t, model)[0] == y for _, t, y, _ in rows]) > 0.97
    whole = language.train([t for _, t, _, _ in rows], [y for _, _, y, _ in rows])
    one = language.fit(frame(spark, rows, clash=False))
    assert one.languages == whole.languages and (one.weights == whole.weights).all() and one.temperature == whole.temperature


def test_language_without_anything_to_learn(spark):
    df = frame(spark, documents(size=6), clash=False)
    assert language.fit(df.limit(0)) is None
    assert {r["lang_pred"] for r in language.identify(df, None).collect()} == {"und"}
    assert language.identify(df.limit(0), None).collect() == []


def test_training_is_sparse_and_calibrated():
    rng = random.Random(3)
    texts = [prose(rng, 40, y) for y in ("en", "fr") * 60]
    model = language.train(texts, ["en", "fr"] * 60)
    assert (model.weights == 0).mean() > 0.9 and model.temperature > 0
    assert language.predict(prose(rng, 40, "fr"), model)[0] == "fr"


@pytest.fixture(scope="module")
def restorer():
    rng = random.Random(8)
    text = " ".join(f"{prose(rng, 5)} you are an idiot and a stupid loser of worthless trash" for _ in range(300))
    counts = np.bincount(toxicity.trigrams(text), minlength=toxicity.LETTERS**3)
    return toxicity.Restorer(toxicity.costs(counts))


def every_path(restorer, text):
    """The least cost of all meanings of a text, each tried."""
    best, choices, before = None, [], ""
    for c in text:
        choices.append(restorer._choices(c, before))
        before = c
    for way in itertools.product(*choices):
        a = b = 0
        total = 0.0
        for x, cost in way:
            code = toxicity._code(x) if x else -1
            if code < 0:
                total += cost
            elif code or b:
                total += cost + restorer.table[a][b][code]
                a, b = b, code
        total += restorer.table[a][b][0]
        written = "".join(x for x, _ in way)
        if best is None or total < best[0] - 1e-9:
            best = (total, {" ".join(written.split())})
        elif total < best[0] + 1e-9:
            best[1].add(" ".join(written.split()))
    return best[1]


def test_the_best_path_of_all(restorer):
    rng = random.Random(12)
    for _ in range(400):
        text = "".join(rng.choices("abdegilost0134568$!|(*@+- .x", k=rng.randint(1, 6)))
        assert " ".join(restorer.stretch(text).split()) in every_path(restorer, text), text


def test_words_that_need_no_lattice(restorer):
    """What is told of a word without its lattice is what the lattice would tell."""
    rng = random.Random(13)
    known = {u: 1.0 for w in ("idiot", "stupid", "scum", "loser", "is", "as", "trolls", "moron") for u in toxicity.units(w)}
    scorer, plain = toxicity.Scorer((known, 0.0), restorer), 0
    heads, tails = ["", "(", "!", "$", '"', "|", '("', "*", "-$"], ["", "!", "!!", ".", "$", ").", "*", "|", '!"', "?!"]
    for _ in range(6000):
        word = rng.choice(["idiot", "idiiot", "stupid", "tupid", "cum", "scum", "loser", "losers", "rolls", "trol", "moon", "dioot", "a", "i", "table"])
        word = "".join(c * rng.choice([1, 1, 1, 1, 2, 3]) if rng.random() < 0.4 else c for c in word)
        text = rng.choice(heads) + word + rng.choice(tails)
        told = scorer._plain(text)
        if told is not None:
            plain += 1
            forms = ([u for u in toxicity.units(x) if u in known] for x in restorer.forms(text))
            assert told == next(filter(None, forms), []), text
    assert plain > 1000


@pytest.mark.parametrize(
    "written, meant",
    [("1d10t", "idiot"), ("idiooooot", "idiot"), ("i d i o t", "idiot"), ("stup!d", "stupid"), ("l0$er", "loser"), ("tr@sh", "trash"),
     ("s-t-u-p-i-d", "stupid"), ("the idiot", "the idiot"), ("Idiot!!", "idiot"), ("", ""), (None, ""), ("...", "")],
)
def test_restoring(restorer, written, meant):
    assert toxicity.restore(written, restorer) == meant


@pytest.mark.parametrize(
    "written, meant",
    [("$tupid", "stupid"), ("!diot", "idiot"), ("|diot!!", "idiot"), ("!d!0t", "idiot"), ("(trash)", "trash"), ("tra$h,", "trash"),
     ("worthle$$", "worthless"), ("worthle$$!", "worthless"), ("idioot", "idiot"), ("stuupid", "stupid"), ("worthless", "worthless")],
)
def test_disguised_edges_and_doubled_letters(restorer, written, meant):
    weights = {w: 1.0 for w in ("stupid", "idiot", "trash", "worthless")}
    assert toxicity.Scorer((weights, 0.0), restorer).units(written) == {meant}


def test_toxicity_on_held_out_texts(spark):
    rng = random.Random(6)
    bad = ["idiot", "stupid", "loser", "trash"]
    hidden = {"idiot": "1d1ot", "stupid": "s t u p i d", "loser": "looooser", "trash": "tr@sh"}
    rows, labels = [], []
    for i in range(240):
        words = prose(rng, 40).split()
        if i % 4 == 0:
            word = rng.choice(bad)
            words.insert(rng.randrange(40), hidden[word] if i % 8 == 0 and i > 120 else word)
        rows.append((i, " ".join(words), "en", None))
        labels.append((i, int(i % 4 == 0), 1))
    rows += [(900, None, None, None), (901, "", None, None), (None, "x", None, None), (902, "z" * 50_000, None, None)]
    df = frame(spark, rows)
    known = spark.createDataFrame([*labels, (5, None, 1), (None, 1, 1), (7777, 1, 1)], "doc_id long, toxic int, TOXIC int")
    model = toxicity.fit(df, known.where("doc_id < 140"))
    got = toxicity.score_toxicity(df, model, with_text=True).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["doc_id"] is not None and 140 <= r["doc_id"] < 240]
    assert np.mean([r["predicted"] == (r["doc_id"] % 4 == 0) for r in held]) > 0.95
    empty = {r["doc_id"]: r["predicted"] for r in got}
    assert empty[900] == empty[901] == 0
    nothing = toxicity.fit(df.limit(0), known.limit(0))
    assert toxicity.score_toxicity(df.limit(0), nothing).collect() == []
