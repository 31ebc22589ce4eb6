"""A Merkle manifest of a dataset: one root, and a proof for every row.

Rows become leaf digests, ordered within their source; every run of ``fanout`` nodes
becomes one node above, until one is left, the subroot of the source. The subroots,
ordered by source, give the root in the same way.

The ordered leaves of a source are cut into aligned blocks of ``fanout ** height``, each of
which knows its own subtree. Above the blocks the tree is climbed by a butterfly exchange:
in round j, blocks that hold subtrees of ``fanout ** j`` blocks meet, one of each of the
``fanout`` subtrees of a node, swap their roots, and each computes the node's digest for
itself. After as many rounds as there are levels every block knows its subroot and all
siblings on its way there: nothing has to be sent down the tree. Where the last subtree of
a node has fewer blocks than the others, its blocks answer for the missing ones, so no
block is met by more than ``fanout - 1`` others at a time.

A digest is the SHA-256, in lowercase hex, of its inputs one after the other, digests as
hex text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from hashlib import sha256
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..operators.ordered import positioned
from ..staging import scratch, stage
from .common import pick, shuffles, staged, table


class Shape(NamedTuple):
    """Nodes under a node, and levels of the subtree over a block of leaves."""

    fanout: int = 3
    height: int = 7

    @property
    def block(self) -> int:
        return self.fanout**self.height


SHAPE = Shape()
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")  # fixed value: what a leaf covers, in this order


def digest(*inputs: str) -> str:
    return sha256("".join(inputs).encode()).hexdigest()


def levels(n: int, fanout: int) -> int:
    """How many levels lie above ``n`` leaves."""
    count = 0
    while n > 1:
        n, count = -(-n // fanout), count + 1
    return count


def field(value: Column) -> Column:
    """A value with its length in UTF-8 bytes before it, or ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, columns)).cast("binary"), 256)


# --- blocks of leaves ---------------------------------------------------------------------


def subtree(leaves: Sequence[str], height: int, fanout: int) -> list[list[str]]:
    """The nodes of each level from the leaves up, ``height`` levels above them."""
    out = [list(leaves)]
    for _ in range(height):
        below = out[-1]
        out.append([digest(*below[i : i + fanout]) for i in range(0, len(below), fanout)])
    return out


def siblings(tree: list[list[str]], at: int, fanout: int) -> list[str]:
    """The siblings of leaf ``at`` and of the nodes above it, up to the top of ``tree``."""
    out = []
    for level in tree[:-1]:
        first = at // fanout * fanout
        out += level[first:at] + level[at + 1 : first + fanout]
        at //= fanout
    return out


def _key(source: Column) -> Column:
    """A source as text that sorts bytewise, null first, and is never null."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def _ordered(leaves: DataFrame, order: Sequence[str], name: str, shape: Shape) -> DataFrame:
    """``leaves`` (key, leaf, more columns) with each one's place ``pos`` among those of its
    key, in the order of the columns ``order``, and their number ``of``; in buckets of
    their block."""
    fixed = staged(leaves.withColumn("_n", F.monotonically_increasing_id()), f"{name}-leaves")
    rows = positioned(fixed, [F.asc_nulls_first(c) for c in ("key", *order, "leaf", "_n")], f"{name}-ordered").df
    # One row per key and partition: where the key begins there, and how many came before.
    runs = rows.groupBy("key", "_part").agg(F.min("_pos").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy("key")
    runs = runs.select(
        "key", "_part", "_first", F.sum("_rows").over(whole).alias("of"),
        F.coalesce(F.sum("_rows").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
    )
    placed = rows.join(runs, ["key", "_part"]).withColumn("pos", F.col("_before") + F.col("_pos") - F.col("_first"))
    placed = placed.select(*leaves.columns, "pos", "of", F.expr(f"pos div {shape.block}").alias("block"))
    return stage(placed, f"llm-{name}-blocks", buckets=(shuffles(leaves.sparkSession), ["key", "block"]), keep=True).df


def _block_roots(placed: DataFrame, shape: Shape) -> DataFrame:
    """(key, block, of, root) of the subtree over each block's leaves; ``of`` counts leaves."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        rows = group.sort_values("pos")
        of = int(rows["of"].iloc[0])
        root = subtree(list(rows["leaf"]), min(shape.height, levels(of, shape.fanout)), shape.fanout)[-1][0]
        return pd.DataFrame({"key": [rows["key"].iloc[0]], "block": [rows["block"].iloc[0]], "of": [of], "root": [root]})

    few = placed.select("key", "block", "of", "pos", "leaf")
    return few.groupBy("key", "block").applyInPandas(run, "key string, block long, of long, root string")


# --- the butterfly ------------------------------------------------------------------------


def _round(blocks: DataFrame, j: int, fanout: int) -> DataFrame:
    """One exchange: blocks (key, block, n, root, proof), whose roots are those of subtrees
    of fanout ** j blocks, get the roots of the next level. ``n`` counts the key's blocks."""
    span = fanout**j
    size = F.least(F.lit(span), F.col("n") - F.col("subtree") * span)
    alone = F.col("n") <= span  # a tree that is done
    rows = blocks.withColumn("subtree", F.expr(f"block div {span}")).withColumn("place", F.col("block") % span)
    # A last, smaller subtree answers for the blocks it lacks, if others are beside it.
    repeat = (size < span) & (F.col("subtree") % fanout > 0)
    last = F.when(repeat, F.lit(span - 1)).otherwise(F.col("place"))
    sent = rows.withColumn("to", F.explode(F.sequence("place", last, F.when(repeat, size).otherwise(F.lit(1)))))
    own = F.when(F.col("to") == F.col("place"), F.struct("block", "subtree", "proof"))
    met = sent.groupBy("key", "n", F.expr(f"subtree div {fanout}").alias("node"), "to").agg(
        F.array_sort(F.collect_list(F.struct("subtree", "root"))).alias("children"), F.collect_list(own).alias("own")
    )
    joined = F.sha2(F.array_join(F.col("children.root"), "").cast("binary"), 256)
    root = F.when(alone, F.col("children")[0]["root"]).otherwise(joined)
    each = met.select("key", "n", "children", root.alias("root"), F.explode("own").alias("me"))
    others = F.expr("transform(filter(children, c -> c.subtree <> me.subtree), c -> c.root)")
    return each.select("key", F.col("me.block").alias("block"), "n", "root", F.concat("me.proof", others).alias("proof"))


def climbed(blocks: DataFrame, name: str, shape: Shape = SHAPE) -> DataFrame:
    """(key, block, of, root) of block subtrees -> (key, block, root, proof): the root of
    the key's tree, and the siblings above each block. As many exchanges as the largest tree
    has levels above its blocks."""
    count = F.expr(f"(of + {shape.block - 1}) div {shape.block}")
    start = staged(blocks.select("key", "block", count.alias("n"), "root", F.expr("cast(array() as array<string>)").alias("proof")), name)
    most = start.agg(F.max("n")).first()[0] or 0
    return staged(reduce(lambda now, j: _round(now, j, shape.fanout), range(levels(most, shape.fanout)), start), name, keep=True).drop("n")


# --- the manifest -------------------------------------------------------------------------


def _forest(leaves: DataFrame, order: Sequence[str], name: str, shape: Shape) -> tuple[DataFrame, DataFrame]:
    """The leaves in their places, and each block's root and proof."""
    with scratch(leaves.sparkSession):
        placed = _ordered(leaves, order, name, shape)
        return placed, climbed(_block_roots(placed, shape), f"{name}-climbed", shape)


def _proofs(placed: DataFrame, uppers: DataFrame, columns: Sequence[str], shape: Shape) -> DataFrame:
    """Each leaf of ``placed`` with its whole proof: the siblings in its block, then those
    that ``uppers`` (key, block, more columns, proof) has for the block."""
    extra = [c for c in uppers.columns if c not in ("key", "block", "proof")]
    out = [*(f for f in placed.schema if f.name in ("key", "pos", "of", *columns)), *(f for f in uppers.schema if f.name in (*extra, "proof"))]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out)
    names, empty = [f.name for f in out], to_arrow_schema(StructType(out)).empty_table()

    def run(leaves: pa.Table, upper: pa.Table) -> pa.Table:
        if not leaves.num_rows:
            return empty
        leaves = leaves.sort_by("pos")
        own = upper.to_pylist()[0]
        height = min(shape.height, levels(leaves["of"][0].as_py(), shape.fanout))
        tree = subtree(leaves["leaf"].to_pylist(), height, shape.fanout)
        proof = [siblings(tree, i, shape.fanout) + own["proof"] for i in range(leaves.num_rows)]
        made = {"proof": pa.array(proof, pa.list_(pa.string()))} | {c: pa.array([own[c]] * leaves.num_rows, upper[c].type) for c in extra}
        return pa.table([made[n] if n in made else leaves[n] for n in names], names)

    return placed.groupBy("key", "block").cogroup(uppers.groupBy("key", "block")).applyInArrow(run, schema)


def manifest(rows: DataFrame, keep: Sequence[str] = (), shape: Shape = SHAPE) -> DataFrame:
    """A proof for every row of ``rows`` (doc_id, source, leaf and the columns ``keep``).

    Returns doc_id, leaf, ``keep``; pos and of, the leaf's place among those of its source
    and their number; top_pos and top_of, the same of the source; subroot, root, and proof:
    the siblings of each level in turn, from left to right, up to the root. Null sources are
    one source, the first; within a source null ids come first, and rows of one id are in
    the order of their leaves. Repeated rows are leaves of their own. A lone leaf is its own
    subroot, a lone subroot the root. An empty table has no root and gives no rows. Memory
    holds a block of fanout ** height leaves; a source may be any share of the rows.
    """
    spark = rows.sparkSession
    leaves = pick(rows, "doc_id", "source", "leaf", *keep)
    leaves = leaves.select(_key(F.col("source")).alias("key"), "doc_id", "leaf", *keep)
    placed, lower = _forest(leaves, ["doc_id"], "manifest", shape)
    with scratch(spark):
        subroots = lower.where("block = 0").select(F.lit("").alias("key"), F.col("root").alias("leaf"), F.col("key").alias("name"))
        tops, upper = _forest(subroots, ["name"], "manifest-top", shape)
        tops = _proofs(tops, upper, ["name"], shape)
        tops = stage(
            tops.select(F.col("name").alias("key"), F.col("pos").alias("top_pos"), F.col("of").alias("top_of"), "root", F.col("proof").alias("above")),
            "llm-manifest-tops", keep=True,
        ).df
    # Blocks, not rows, meet their source: that of a third of the rows is met by few.
    whole = lower.withColumnRenamed("root", "subroot").join(tops, "key")
    whole = whole.select("key", "block", "subroot", "root", "top_pos", "top_of", F.concat("proof", "above").alias("proof"))
    return _proofs(placed, whole, ["doc_id", "leaf", *keep], shape).drop("key")


def folded(leaf: str, proof: Sequence[str], places: Sequence[tuple[int, int]], fanout: int) -> str:
    """The root that a leaf and its proof lead to. ``places``: of each tree on the way, the
    place in it and the number of its leaves."""
    node, taken = leaf, 0
    for at, of in places:
        while of > 1:
            run = min(fanout, of - at // fanout * fanout) - 1
            left = at % fanout
            others = proof[taken : taken + run]
            node, taken = digest(*others[:left], node, *others[left:]), taken + run
            at, of = at // fanout, -(-of // fanout)
    return node


def verified(proofs: DataFrame, leaf: str, keep: Sequence[str], shape: Shape = SHAPE) -> DataFrame:
    """The columns ``keep`` of a manifest, ``folded_root``: where the digest in column
    ``leaf`` leads with the row's proof, and ``verified``, whether that is the root."""
    used = [leaf, "proof", "pos", "of", "top_pos", "top_of", "root"]
    rows = pick(proofs, *dict.fromkeys([*keep, *used]))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[: len(keep)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = (batch.column(name).to_pylist() for name in used)
            found, right = [], []
            for digest_, proof, at, of, top_at, top_of, root in zip(*told):
                found.append(folded(digest_, proof, ((at, of), (top_at, top_of)), shape.fanout))
                right.append(found[-1] == root)
            columns = [*map(batch.column, keep), pa.array(found, pa.string()), pa.array(right, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "folded_root", "verified"])

    return rows.mapInArrow(run, f"{kept}, folded_root string, verified boolean")


def op12_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = pick(table(spark, folder, "documents"), *FIELDS)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")))
    changed = [F.coalesce(tampered, F.col("text")) if c == "text" else F.col(c) for c in FIELDS]
    leaves = docs.select(
        "doc_id", "source", leaf_digest([F.col(c) for c in FIELDS]).alias("leaf"), leaf_digest(changed).alias("tampered")
    )
    proofs = manifest(leaves, keep=["tampered"])
    proofs = proofs.withColumn("proof_sha256", F.sha2(F.array_join("proof", "").cast("binary"), 256))
    out = ["doc_id", "leaf", "subroot", "root", "proof_sha256"]
    return verified(proofs, "tampered", out)


# crc32 modulo 2 bit by bit, as SQL has no such function; trees level by level.
_ODD = """list_reduce(
    flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [unicode(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda crc, step: CASE
        WHEN step >= 0 THEN xor(crc, step)
        ELSE xor(crc // 2, CASE WHEN crc % 2 = 1 THEN 3988292384 ELSE 0 END)
    END, 4294967295::BIGINT)"""
_FIELD = "coalesce(octet_length(encode({0}::VARCHAR))::VARCHAR || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in FIELDS[:-1]) + " || {})"

OP12_SQL = f"""
WITH RECURSIVE hashed AS (
    SELECT doc_id, source, {_LEAF.format(_FIELD.format("text"))} AS leaf,
        {_LEAF.format(_FIELD.format("changed"))} AS tampered
    FROM (
        SELECT *, CASE WHEN {_ODD} % 2 = 1 THEN replace(text, chr(10), '') ELSE text END AS changed
        FROM documents
    )
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY source) AS size
    FROM hashed
), tree AS (
    SELECT 0 AS level, source, pos, size, leaf AS node FROM leaves
    UNION ALL
    SELECT level + 1, source, pos // 3, (size + 2) // 3, sha256(string_agg(node, '' ORDER BY pos))
    FROM tree WHERE size > 1
    GROUP BY level, source, pos // 3, size
), subroots AS (
    SELECT source, node, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS size
    FROM tree WHERE size = 1
), top AS (
    SELECT 0 AS level, pos, size, node FROM subroots
    UNION ALL
    SELECT level + 1, pos // 3, (size + 2) // 3, sha256(string_agg(node, '' ORDER BY pos))
    FROM top WHERE size > 1
    GROUP BY level, pos // 3, size
), proofs AS (
    SELECT l.source, l.pos,
        coalesce(string_agg(t.node, '' ORDER BY t.level, t.pos), '') AS lower
    FROM leaves l JOIN tree t ON t.source IS NOT DISTINCT FROM l.source
        AND t.pos // 3 = l.pos // (3 ** (t.level + 1))::BIGINT AND t.pos <> l.pos // (3 ** t.level)::BIGINT
    GROUP BY l.source, l.pos
), uppers AS (
    SELECT s.source, coalesce(string_agg(t.node, '' ORDER BY t.level, t.pos), '') AS upper
    FROM subroots s JOIN top t ON t.pos // 3 = s.pos // (3 ** (t.level + 1))::BIGINT AND t.pos <> s.pos // (3 ** t.level)::BIGINT
    GROUP BY s.source
), known AS (
    SELECT l.*, s.node AS subroot, s.pos AS top_pos, s.size AS top_size,
        (SELECT node FROM top WHERE size = 1) AS root, coalesce(p.lower, '') AS lower, coalesce(u.upper, '') AS upper
    FROM leaves l
    JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
    LEFT JOIN proofs p ON p.source IS NOT DISTINCT FROM l.source AND p.pos = l.pos
    LEFT JOIN uppers u ON u.source IS NOT DISTINCT FROM l.source
), folding AS (
    SELECT doc_id, source, leaf, pos AS first_pos, subroot, root, lower, upper, top_pos, top_size, false AS above,
        pos, size, tampered AS node, lower AS rest
    FROM known
    UNION ALL
    SELECT doc_id, source, leaf, first_pos, subroot, root, lower, upper, top_pos, top_size,
        above OR size = 1,
        CASE WHEN size = 1 THEN top_pos ELSE pos // 3 END,
        CASE WHEN size = 1 THEN top_size ELSE (size + 2) // 3 END,
        CASE WHEN size = 1 THEN node ELSE sha256(
            substr(rest, 1, 64 * (pos % 3)) || node
            || substr(rest, 64 * (pos % 3) + 1, 64 * (least(3, size - pos // 3 * 3) - 1 - pos % 3))
        ) END,
        CASE WHEN size = 1 THEN upper ELSE substr(rest, 64 * (least(3, size - pos // 3 * 3) - 1) + 1) END
    FROM folding WHERE size > 1 OR NOT above
)
SELECT doc_id, leaf, subroot, root, sha256(lower || upper) AS proof_sha256, node AS folded_root, node = root AS verified
FROM folding WHERE above AND size = 1
"""
