"""Documents with the awkward cases that every operator must take."""

import random

SYLLABLES = {
    "en": ["the", "and", "ing", "er", "tion", "that", "ou", "wh", "st"],
    "fr": ["eau", "é", "que", "aire", "ment", "oi", "ç", "le", "ère"],
}


def prose(rng, n, lang="en"):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n))


def documents(seed=1, size=60):
    """(doc_id, text, lang, source) rows: prose, near and exact copies, shared passages,
    and nulls, empty, blank, short, periodic and very long texts."""
    rng = random.Random(seed)
    passage = prose(rng, 60)
    out = []
    for i in range(size):
        lang = "fr" if i % 3 == 0 else "en"
        text = prose(rng, rng.randint(5, 120), lang)
        if i % 6 == 1:
            text = f"{text} {passage} {prose(rng, 10)}"
        if i % 5 == 4:
            copied, lang = rng.choice([(t, y) for _, t, y, _ in out])
            words = copied.split()
            words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        out.append((i, text, lang, f"src{i % 4}"))
    out += [
        (100, None, "en", "src1"),
        (101, "", None, "src1"),
        (102, " \t\n ", "en", None),
        (103, "One", "en", None),
        (104, "12345 678", "fr", "src2"),
        (105, "ab " * 400, "en", "src2"),
        (106, "é" * 900, "fr", ""),
        (107, prose(rng, 9000), "en", "src3"),
        (108, out[3][1], "fr", "src0"),
        (108, out[3][1], "fr", "src0"),
        (None, out[5][1], "en", "src0"),
        (None, None, None, None),
    ]
    return out


SCHEMA = "doc_id long, text string, lang string, source string"


def frame(spark, rows, clash=True):
    """The rows with columns of names that operators use themselves, or that differ from
    the real ones in case only."""
    df = spark.createDataFrame(rows, SCHEMA)
    if not clash:
        return df
    from pyspark.sql import functions as F

    extra = {n: F.lit(f"extra {n}") for n in ("key", "r", "score", "size", "taken", "row", "n", "code", "block", "order")}
    wide = df.withColumns(extra)
    return wide.toDF(*wide.columns).select("*", F.lit("other").alias("TEXT"), F.lit(-1).alias("Doc_Id"))
