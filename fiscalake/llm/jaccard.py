"""N-gram Jaccard join by prefix filters under several global orders.

A text is the set of its word shingles. Two sets that are alike enough share some of the
first few shingles of both under any order of all shingles. Frequent shingles come last in
every order, so that firsts are rare; the rest of an order is a hash. Under one order after
the other, a text stays a candidate only if enough of its firsts occur in other candidates.
Pairs are formed by the firsts of the last order, and must share enough firsts under each
of the orders before their whole sets are compared, exactly.

All texts with one set are one candidate. Within a group of candidates that share a
shingle, all are first compared with one leader, the member with most in common with the
others: in a family of near copies that joins nearly all of them, and what is joined needs
no further comparison for the components. Pairs between different components are compared
with some more leaders, and at last all of them that share a rare enough shingle; texts
with fewer firsts shared between components than a link asks for are left out before. So
every link that could join two components is found, and a family of copies, however large,
takes about as many comparisons as it has members.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..staging import drop, scratch, stage
from .common import Numbered, mix64, pick, raw, shuffles, staged, table
from .distinct import (
    BLOBS,
    Postings,
    distinct_texts,
    merged,
    mixed,
    repeated,
    text_key,
    union,
    with_texts,
)

WORDS, NUMERATOR, DENOMINATOR = 5, 4, 5  # shingles of 5 words; alike from 4/5 on
ORDERS = 3
BANDS = ((0.9, 1.0), (NUMERATOR / DENOMINATOR, 0.9))  # ratios of sizes that are paired in one go
PLACES = 22  # leading bits of a code: the place at which texts with it are counted
BLOCK = 1 << 16  # places that are added up in one go
OFTEN = 8  # texts, at least, that have a frequent shingle
LEADERS = (1, 8)  # of a group, in the first rounds
WORDS_OF_BITS = 8  # numbers that hold a set's parities
BITS = [f"p{i}" for i in range(WORDS_OF_BITS)]
FEW = 62  # shared codes up to which all that are needed are used
CODES = 8  # of a set by which it meets leaders
CHUNK = 400  # texts compared with one leader in one go
MULTIPLY = np.uint64(0x9E6C63D0876A9A47)


class Shingles:
    """Sets of shingles as sorted 64-bit codes; the codes of words are kept by number."""

    def __init__(self, words: int = WORDS, limit: int = 500_000):
        self.size = words
        self.words = Numbered(limit, self._empty)
        self._empty()

    def _empty(self) -> None:
        self.codes, self.held = np.empty(1024, np.uint64), 0

    def of(self, text: bytes | None) -> np.ndarray:
        """The set of a text: its shingles, or with too few words all its words as one."""
        self.words.make_room()
        words = (text or b"").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        numbers, new = self.words.number(words)
        if new:
            if self.held + len(new) > len(self.codes):
                self.codes = np.concatenate([self.codes, np.empty(len(self.codes) + len(new), np.uint64)])
            self.codes[self.held : self.held + len(new)] = [xxhash.xxh3_64_intdigest(w) for w in new]
            self.held += len(new)
        each = self.codes[numbers]
        size = min(self.size, len(words))
        n = len(words) - size + 1
        code = np.full(n, size, np.uint64)
        for j in range(size):
            code = code * MULTIPLY + each[j : j + n]
        return np.unique(mix64(code))


def parities(codes: np.ndarray) -> np.ndarray:
    """A set as ``64 * WORDS_OF_BITS`` bits, each the parity of the codes that fall on it.
    Codes that two sets share cancel out: sets differ in as many codes, at least, as they
    differ in bits."""
    at = mixed(codes, 55) % np.uint64(64 * WORDS_OF_BITS)
    odd = np.bincount(at.astype(np.int64), minlength=64 * WORDS_OF_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def needed(n):
    """The least number of shingles that a set of ``n`` shares with any it is linked to."""
    return (NUMERATOR * n + DENOMINATOR - 1) // DENOMINATOR


def spare(n):
    """How many firsts a set of ``n`` must share at least: a longer prefix asks for more."""
    return 1 + 2 * n // 25


def places(codes: np.ndarray) -> np.ndarray:
    return (codes >> np.uint64(64 - PLACES)).astype(np.int64)


def firsts(codes: np.ndarray, hot: np.ndarray, seed: int) -> np.ndarray:
    """A set's prefix under order ``seed``; ``hot`` tells the places of frequent shingles."""
    n = len(codes)
    key = mixed(codes, seed) >> np.uint64(1)
    if len(hot):
        key |= hot[places(codes)].astype(np.uint64) << np.uint64(63)
    count = min(n, n - needed(n) + spare(n))
    return codes[np.argpartition(key, count - 1)[:count]] if count < n else codes


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return DENOMINATOR * common >= NUMERATOR * (len(a) + len(b) - common)


def _frequent(texts: DataFrame) -> np.ndarray:
    """Whether the shingles at each place are frequent, counted over all texts: more sets
    have them than two average places and chance account for. These are put last in every
    order. Empty if none are."""

    def run(batches):
        shingles, counts, waiting, size = Shingles(), np.zeros(1 << PLACES, np.uint32), [], 0

        def add():
            counts[:] += np.bincount(np.concatenate(waiting), minlength=1 << PLACES).astype(np.uint32)

        for batch in batches:
            for text in raw(batch.column(0)):
                waiting.append(places(shingles.of(text)))
                size += len(waiting[-1])
                if size > 3_000_000:
                    add()
                    waiting, size = [], 0
        if waiting:
            add()
        for at in range(0, 1 << PLACES, BLOCK):
            own = counts[at : at + BLOCK]
            if own.any():
                # Byte by byte of the counts: the high ones are nearly all 0.
                packed = pa.compress(own.view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True)
                yield pa.RecordBatch.from_pydict({"block": [at // BLOCK], "n": [int(own.sum(dtype=np.int64))], "counts": [packed]})

    counted = staged(texts.select("text").mapInArrow(run, "block long, n long, counts binary"), "jaccard-counts")
    mean = (counted.agg(F.sum("n")).first()[0] or 0) / (1 << PLACES)
    least = max(OFTEN, 2 * mean + 6 * math.sqrt(mean))

    def mark(rows: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK, np.int64)
        for packed in rows["counts"].to_pylist():
            planes = np.frombuffer(pa.decompress(packed, 4 * BLOCK, "zstd", asbytes=True), np.uint8)
            total += np.ascontiguousarray(planes.reshape(4, -1).T).view(np.uint32)[:, 0]
        return pa.table({"block": rows["block"][:1], "frequent": [np.packbits(total >= least).tobytes()]})

    hot = np.zeros(1 << PLACES, bool)
    for block, bits in counted.groupBy("block").applyInArrow(mark, "block long, frequent binary").collect():
        hot[block * BLOCK : (block + 1) * BLOCK] = np.unpackbits(np.frombuffer(bits, np.uint8))
    return hot if hot.any() else hot[:0]


SETS = pa.schema([(c, pa.binary() if c == "key" else pa.int64()) for c in ("r", "key", "n", "f1", "f2")])
PACKED = pa.schema([("bucket", pa.int32()), ("codes", pa.binary()), ("base", pa.int64()), ("rows", pa.binary())])
PASSED = "r long, key binary, n long, f1 long, f2 long, " + BLOBS


def _beside(schema: pa.Schema, columns: dict, n: int) -> pa.RecordBatch:
    """Rows of the columns that ``schema`` has, the others of PASSED null."""
    fields = [*SETS, *PACKED]
    made = [pa.array(columns[f.name], f.type) if f.name in schema.names else pa.nulls(n, f.type) for f in fields]
    return pa.RecordBatch.from_arrays(made, schema=pa.schema(fields))


def _sets(texts: DataFrame, hot, buckets: int) -> DataFrame:
    """One pass over all texts: (r, key, n, f1, f2) of each set, and packed postings of the
    firsts of the first order."""

    def run(batches):
        shingles, out = Shingles(), Postings(buckets)
        frequent = hot.value
        for batch in batches:
            found = [shingles.of(t) for t in raw(batch.column(2))]
            rows = batch.column(1).to_pylist()
            prints = [[int(mixed(x, s).sum().view(np.int64)) if len(x) else 0 for x in found] for s in (101, 102)]
            own = (rows, batch.column(0).to_pylist(), [len(x) for x in found], *prints)
            yield _beside(SETS, dict(zip(SETS.names, own)), len(found))
            for r, codes in zip(rows, found):
                if len(codes):
                    out.add(firsts(codes, frequent, 0), r)
                if out.size > out.most:
                    for row in out.flush():
                        yield _beside(PACKED, row, 1)
        for row in out.flush():
            yield _beside(PACKED, row, 1)

    return texts.select("key", "r", "text").mapInArrow(run, PASSED)


def _later_orders(texts: DataFrame, some: DataFrame, hot, buckets: int) -> DataFrame:
    """One pass over the texts of the sets ``some``: (r, o0, o1, ..., p0, p1, ...), the
    firsts of each set under all orders and its parities, and packed postings of the firsts
    under the later orders, bucket numbers of which start at ``order * buckets``."""
    orders = [f"o{seed}" for seed in range(ORDERS)]
    fields = [pa.field("r", pa.int64()), *(pa.field(o, pa.list_(pa.int64())) for o in orders)]
    fields += [*(pa.field(p, pa.int64()) for p in BITS), *PACKED]
    schema = pa.schema(fields)

    def run(batches):
        shingles, out = Shingles(), [Postings(buckets) for _ in range(1, ORDERS)]
        frequent = hot.value

        def pack(seed: int):
            for row in out[seed - 1].flush():
                row["bucket"] = [row["bucket"][0] + seed * buckets]
                made = [pa.array(row[f.name], f.type) if f.name in PACKED.names else pa.nulls(1, f.type) for f in fields]
                yield pa.RecordBatch.from_arrays(made, schema=schema)

        for batch in batches:
            rows, lists, bits = batch.column(1).to_pylist(), [[] for _ in orders], []
            for text, r in zip(raw(batch.column(0)), rows):
                codes = shingles.of(text)
                bits.append(parities(codes))
                for seed in range(ORDERS):
                    lists[seed].append(np.sort(firsts(codes, frequent, seed)).view(np.int64))
                    if seed:
                        out[seed - 1].add(lists[seed][-1].view(np.uint64), r)
            made = [pa.array(rows, pa.int64()), *(pa.array(x, pa.list_(pa.int64())) for x in lists)]
            made += [pa.array(p, pa.int64()) for p in np.array(bits, np.int64).reshape(-1, WORDS_OF_BITS).T]
            made += [pa.nulls(len(rows), f.type) for f in PACKED]
            yield pa.RecordBatch.from_arrays(made, schema=schema)
            for seed in range(1, ORDERS):
                if out[seed - 1].size > out[seed - 1].most:
                    yield from pack(seed)
        for seed in range(1, ORDERS):
            yield from pack(seed)

    columns = "r long, " + ", ".join([*(f"{o} array<long>" for o in orders), *(f"{p} long" for p in BITS)])
    return with_texts(texts, some.select("key", "r"), "text").select("text", "r").mapInArrow(run, f"{columns}, {BLOBS}")


def _shared_by(groups: DataFrame, candidates: DataFrame) -> DataFrame:
    """The candidates (r, key, n) with enough of their firsts in ``groups`` (code, r)."""
    shared = groups.groupBy("r").agg(F.count("*").alias("shared"))
    return candidates.join(shared, "r").where(F.col("shared") >= _least(F.col("n"))).select("r", "key", "n")


def _compare(texts: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, linked) for ``pairs`` (a, b). Texts go to their leader a in chunks, so that a
    leader of any number of texts is spread, and each set is held one at a time."""
    counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    dealt = pairs.join(counts, "a").withColumn("chunk", F.pmod(F.xxhash64("b"), F.col("chunks")))
    heads = counts.select("a", F.col("a").alias("b"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
    wanted = staged(dealt.select("a", "b", "chunk").unionByName(heads), "jaccard-dealt")
    keys = sets.select("key", F.col("r").alias("b"))
    # Each text is read once, then joined to the places it is needed at.
    found = with_texts(texts, wanted.select("b").distinct().join(keys, "b"), "text")
    rows = wanted.join(found.select("b", "text"), "b")

    def run(batches):
        shingles, head, own = Shingles(), None, None
        for batch in batches:
            out = {"a": [], "b": [], "linked": []}
            for a, chunk, b, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), raw(batch.column(3))):
                found = shingles.of(text)
                if a == b:
                    head, own = (a, chunk), found
                    continue
                assert head == (a, chunk), "a leader comes before its texts"
                out["a"].append(a)
                out["b"].append(b)
                out["linked"].append(linked(own, found))
            yield pa.RecordBatch.from_pydict(out, pa.schema([("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_())]))

    n = shuffles(texts.sparkSession)
    sorted_rows = rows.select("a", "chunk", "b", "text").repartition(n, "a", "chunk").sortWithinPartitions("a", "chunk", F.col("a") != F.col("b"))
    return staged(sorted_rows.mapInArrow(run, "a long, b long, linked boolean"), "jaccard-compared")


def _star(members: DataFrame, leaders: DataFrame) -> DataFrame:
    """Pairs of a group's leaders (code, a, na, ca, parities) with its members (code, r, n,
    c, parities) in other components, once for each code, if their sizes and the bits in
    which they differ leave room for a link: linked sets differ in a ninth of both at most."""
    small, large = F.least("n", "na"), F.greatest("n", "na")
    apart = sum((F.bit_count(F.col(p).bitwiseXOR(F.col(f"{p}a"))) for p in BITS), F.lit(0))
    return members.join(leaders, "code").where(
        (F.col("r") != F.col("a")) & (F.col("c") != F.col("ca")) & (DENOMINATOR * small >= NUMERATOR * large)
        & ((NUMERATOR + DENOMINATOR) * apart <= (DENOMINATOR - NUMERATOR) * (F.col("n") + F.col("na")))
    )


def _as_leaders(members: DataFrame) -> DataFrame:
    return members.select("code", F.col("r").alias("a"), F.col("n").alias("na"), F.col("c").alias("ca"), *(F.col(p).alias(f"{p}a") for p in BITS))


def _least(n: Column) -> Column:
    """How many firsts a set of ``n`` shares at least with any it is linked to."""
    return 1 + F.floor(2 * F.ceil(n * NUMERATOR / DENOMINATOR) / 25)


def _enough(n: str, other: str) -> Column:
    """How many firsts sets of these sizes share at least if they are linked: what they must
    have in common less what can lie behind the prefix of either. The larger set does not
    always have more behind it: of 24 shingles it is 18, of 25 it is 17."""
    both = F.col(n) + F.col(other)
    behind = [F.ceil(x * NUMERATOR / DENOMINATOR) - (1 + F.floor(2 * x / 25)) for x in (F.col(n), F.col(other))]
    return F.greatest(F.ceil(both * NUMERATOR / (NUMERATOR + DENOMINATOR)) - F.greatest(*behind), F.lit(1))


def _central(members: DataFrame, classes: int) -> DataFrame:
    """The most central member of each group, or of each of some classes of its members."""
    best = F.max(F.struct("w", F.col("r"), "n", "c", *BITS)).alias("m")
    own = members.groupBy("code", F.pmod(F.xxhash64("r"), F.lit(classes)).alias("class")).agg(best)
    return own.select("code", "m.r", "m.n", "m.c", *(f"m.{p}" for p in BITS))


def _sharing(pairs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) that share enough firsts to be linked under every order."""
    orders = [f"o{seed}" for seed in range(ORDERS)]
    ends = [prefixes.select(*(F.col(x).alias(f"{x}_{e}") for x in ("r", "n", *orders))) for e in ("a", "b")]
    both = pairs.join(ends[0], F.col("a") == F.col("r_a")).join(ends[1], F.col("b") == F.col("r_b"))
    enough = _enough("n_a", "n_b")
    for o in orders:
        both = both.where(F.size(F.array_intersect(f"{o}_a", f"{o}_b")) >= enough)
    return both.select("a", "b")


def _leading(groups: DataFrame) -> DataFrame:
    """Groups (code, r, n, k) cut to about ``CODES`` of each member's codes, drawn by the
    code and the size of the set: alike sets keep the same ones. What leaders are found by."""
    prefix = F.col("n") - F.ceil(F.col("n") * NUMERATOR / DENOMINATOR) + 1 + F.floor(2 * F.col("n") / 25)
    return groups.where(F.pmod(F.xxhash64("code"), F.lit(1 << 20)) * prefix < F.col("k") * (CODES << 20))


def _one_of_equal(postings: DataFrame) -> DataFrame:
    """(code, r, size, k) of the codes that several of the postings (code, r) have, one for
    all codes that the same sets have: ``size`` sets have each of ``k`` codes. Long texts
    share their codes in hundreds; pairs are formed by one of them."""
    marks = [F.bit_xor(F.xxhash64("r", F.lit(seed))).alias(f"mark{seed}") for seed in (1, 2)]
    lists = postings.groupBy("code").agg(F.count("*").alias("size"), *marks).where("size > 1")
    kinds = lists.groupBy("size", "mark1", "mark2").agg(F.min("code").alias("code"), F.count("*").alias("k"))
    return postings.join(kinds.select("code", "size", "k"), "code")


def _open(members: DataFrame) -> DataFrame:
    """Of groups' members (code, r, n, c, k) those that a link to another component can
    still have: their code has members of several components, and they have as many such
    codes as a link asks for. With the ``size`` of each group."""
    spread = members.groupBy("code").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count("*").alias("size"))
    members = members.join(spread.where("low <> high").select("code", "size"), "code")
    have = F.sum("k").over(Window.partitionBy("r"))
    return members.withColumn("open", have).where(F.col("open") >= _least(F.col("n"))).drop("open")


def _rest(members: DataFrame, bits: DataFrame, low: float, high: float) -> DataFrame:
    """All pairs of members (code, r, n, c, k, come) in different components, the smaller
    set ``low`` to ``high`` of the larger, that can be linked.

    They share at least some number of codes, so that many less one of a member's codes can
    go, those of the largest groups. ``come`` counts a member's codes from these on. Sets
    that share very many are met by fewer: codes are drawn by a hash, the same for all, so
    that the odds to draw none of those shared are below 2 ** -64, those of equal codes."""
    share = NUMERATOR / (NUMERATOR + DENOMINATOR) * (1 + low) - NUMERATOR / DENOMINATOR + 0.08
    least = F.greatest(F.floor(F.col("n") * share) - 2, _least(F.col("n")) if low <= NUMERATOR / DENOMINATOR else F.lit(1))
    drawn = F.pmod(F.xxhash64("code", F.lit(7)), F.lit(1 << 40)) < (1 - F.pow(F.lit(2.0), -64 / least)) * (1 << 40)
    kept = members.where(F.when(least <= FEW, F.col("come") >= least).otherwise(drawn)).select("code", "r", "n", "c")
    kept = _one_of_equal(kept).drop("size", "k").join(bits, "r")
    # Pairs of two members of a group's largest component are none; the others lead.
    sizes = kept.groupBy("code", "c").agg(F.count("*").alias("k"))
    main = sizes.groupBy("code").agg(F.max_by("c", F.struct("k", "c")).alias("main"))
    leaders = kept.join(main, "code").where("c <> main").drop("main")
    ratio = F.least("n", "na") / F.greatest("n", "na")
    return _star(kept, _as_leaders(leaders)).where((ratio >= low) & ((ratio < high) | F.lit(high >= 1)))


def similar_sets(texts: DataFrame, sets: DataFrame, hot) -> DataFrame:
    """(r, c): components of the candidates in ``sets`` (r, key, n), which have passed the
    first order, that links join."""
    spark = texts.sparkSession
    buckets, candidates = shuffles(spark), sets
    later = staged(_later_orders(texts, candidates, hot, buckets), "jaccard-orders")
    for seed in range(1, ORDERS):
        own = later.where(F.col("bucket").between(seed * buckets, seed * buckets + buckets - 1))
        groups = staged(repeated(own.select("bucket", "codes", "base", "rows")), "jaccard-firsts")
        candidates = staged(_shared_by(groups, candidates), "jaccard-candidates")
    orders = [f"o{seed}" for seed in range(ORDERS)]
    prefixes = staged(later.where(F.col("r").isNotNull()).select("r", *orders, *BITS).join(candidates.select("r", "n"), "r"), "jaccard-prefixes")
    # A member is the more central the more members share its codes: the original of a
    # family of copies comes before those that were changed most.
    groups = staged(_one_of_equal(groups.join(candidates.select("r", "n"), "r")), "jaccard-groups")
    central = groups.groupBy("r").agg((F.sum(F.col("size") * F.col("k")) / F.first("n")).alias("w"))
    bits = prefixes.select("r", *BITS)
    leading = staged(_leading(groups.drop("size")).join(central, "r").join(bits, "r"), "jaccard-leading")

    compared: list[DataFrame] = []
    found = spark.createDataFrame([], "r long, c long")
    for classes in (*LEADERS, None):
        some = leading if classes else groups.drop("size")
        members = some.join(found, "r", "left").withColumn("c", F.coalesce("c", "r"))
        if classes:
            # What is still open: codes whose members are in more than one component.
            spread = members.groupBy("code").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high")
            members = staged(members.join(spread.select("code"), "code"), "jaccard-open")
            pairs = _star(members, _as_leaders(_central(members, classes)))
        else:
            # Of a member's codes, from those of the largest groups on, how many have come.
            largest = Window.partitionBy("r").orderBy(F.desc("size"), "code").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            members = staged(_open(members).withColumn("come", F.sum("k").over(largest)), "jaccard-open")
            pairs = union([_rest(members, bits, low, high) for low, high in BANDS])
        pairs = pairs.select(F.least("a", "r").alias("a"), F.greatest("a", "r").alias("b")).distinct()
        if compared:
            pairs = pairs.join(union(compared).select("a", "b"), ["a", "b"], "left_anti")
        pairs = staged(_sharing(pairs, prefixes), "jaccard-round")
        if pairs.isEmpty():
            continue
        compared.append(_compare(texts, sets, pairs))
        found = merged(found, compared[-1].where("linked"))
    return found


def _placed(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n_shingles, c) for every row: its text's key, and its component by
    number, null for an empty set."""
    spark = docs.sparkSession
    with scratch(spark):
        texts = distinct_texts(docs)
        rows = pick(docs, "doc_id", "text").select("doc_id", text_key(F.col("text")).alias("key"))
        hot = spark.sparkContext.broadcast(_frequent(texts))
        passed = stage(_sets(texts, hot, shuffles(spark)), "llm-jaccard-passed")
        every = passed.df.where(F.col("r").isNotNull() & (F.col("n") > 0)).select("r", "key", "n", "f1", "f2")
        every = staged(every, "jaccard-sets")
        postings = passed.df.where(F.col("bucket").isNotNull()).select("bucket", "codes", "base", "rows")
        classes = every.groupBy("f1", "f2", "n").agg(F.min(F.struct("r", "key")).alias("one"))
        classes = staged(classes.select("f1", "f2", "n", "one.r", "one.key"), "jaccard-classes")
        candidates = staged(_shared_by(repeated(postings), classes.select("r", "key", "n")), "jaccard-candidates")
        drop(spark, passed)  # by far the largest of these tables
        found = similar_sets(texts, candidates, hot)
        joined = classes.join(found, "r", "left").select("f1", "f2", "n", F.coalesce("c", "r").alias("c"))
        by_key = staged(every.join(joined, ["f1", "f2", "n"]).select("key", "n", "c"), "jaccard-texts")
        size = F.coalesce("n", F.lit(0).cast("long")).alias("n_shingles")
        return staged(rows.join(by_key, "key", "left").select("doc_id", "key", size, "c"), "jaccard-rows", keep=True)


def join_texts(docs: DataFrame) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): doc_id, n_shingles (size of its set) and
    component_id, the smallest doc_id that links lead to, its own included.

    A set holds the distinct shingles of five words of the lower-cased text (A to Z); a
    text of fewer words is one shingle. Sets are linked from a Jaccard similarity of 0.8
    on. Null, empty and blank texts have an empty set and are linked with nothing; their
    component is their own doc_id. Rows with the same text or set are linked; a null doc_id
    is never the smallest unless no row of its component has another. Whole texts count. An
    empty table gives an empty result. A word is taken for its 64-bit code.
    """
    placed = _placed(docs)
    smallest = placed.where(F.col("c").isNotNull()).groupBy("c").agg(F.min("doc_id").alias("smallest"))
    own = F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("smallest"))
    return placed.join(smallest, "c", "left").select("doc_id", "n_shingles", own.alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and other columns) with one row of each component: that of the
    smallest doc_id, nulls last, and of rows with the same doc_id the first by a hash of
    the text. Texts without words are in no component and stay; equal rows become one."""
    placed = _placed(docs)
    first = placed.where(F.col("c").isNotNull()).groupBy("c").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("one"))
    keep = first.select("one.doc_id", "one.key").unionByName(placed.where(F.col("c").isNull()).select("doc_id", "key").distinct())
    keep = keep.select(F.col("doc_id").alias("_id"), F.col("key").alias("_of"))
    rows = docs.withColumn("_key", text_key(F.col("text")))
    kept = rows.join(keep, rows["doc_id"].eqNullSafe(F.col("_id")) & rows["_key"].eqNullSafe(F.col("_of")), "left_semi")
    # Equal rows are rare: only where there are some do the texts have to move once more.
    if not placed.groupBy("doc_id", "key").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", "_key"])
    return kept.drop("_key")


def op9_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return join_texts(table(spark, folder, "documents"))
