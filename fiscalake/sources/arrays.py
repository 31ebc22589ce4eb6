"""Files that hold one JSON array of objects, read by many tasks.

A reader that needs the whole array gives a file to one task. Here the file is read as
text that is cut at every ``}``, which Spark splits like any text file. What a piece means
depends on what comes before it: whether it begins inside a string, and how many objects
are open. Quotes and braces of each piece are counted once for either beginning; sums over
a split's pieces, and over the splits of a file, one row each, then tell where every split
begins. Where each piece is one object then, as in most files, the text is read once more
and parsed where it is. In other splits sums over the pieces before each one tell where
records begin. A record of one piece is parsed as it is. The others, with objects or braces
inside, are put together first; one that goes over the border of a split is found by what
the splits before it leave open.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import RAW
from ..staging import stage

SPLIT = ["_file", "_block"]


def _pieces(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Text up to each closing brace, with its file, its split and its order there."""
    text = spark.read.option("lineSep", "}").text(list(paths))
    return text.select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_order"),
    )


def _times(text: Column, mark: str) -> Column:
    """How often a character of one byte is in a text."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(mark), F.lit("")))


def _outer(text: Column) -> Column:
    """Opening braces outside of strings in a text that begins outside: mostly all of them,
    before the first quote; else those in every other part of the text cut at its quotes."""
    own = F.filter(F.split(text, '"'), lambda _, i: i % 2 == 0)
    before = _times(F.substring_index(text, '"', 1), "{")
    return F.when(before == _times(text, "{"), before).otherwise(_times(F.array_join(own, ""), "{"))


def _bare() -> Column:
    """A piece without what backslashes escape."""
    return F.when(F.contains("value", F.lit("\\")), F.regexp_replace("value", r"(?s)\\.", "")).otherwise(F.col("value"))


def _marked(pieces: DataFrame) -> DataFrame:
    """``quotes`` (0 or 1) that a piece leaves open if it begins outside a string, and the
    braces opened in what is outside then (``outer``), or if it begins inside (``inner``).
    A backslash and the character after it are in one piece, as no brace is escaped."""
    marked = pieces.withColumn("_bare", _bare()).withColumns(
        {"quotes": _times(F.col("_bare"), '"') % 2, "outer": _outer(F.col("_bare")), "inner": _times(F.col("_bare"), "{")}
    )
    return marked.withColumn("inner", F.col("inner") - F.col("outer")).drop("_bare")


def _counted(marked: DataFrame) -> DataFrame:
    """How many objects each piece opens, and leaves open, for either beginning of its split."""
    before = Window.partitionBy(*SPLIT).orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
    # Only a brace outside of strings closes; each piece but a file's last ends with one.
    closed = 1 - (inside + F.col("quotes")) % 2
    return marked.withColumns(
        {
            "grown": F.when(inside == 0, F.col("outer")).otherwise(F.col("inner")) - closed,
            "grown_in": F.when(inside == 0, F.col("inner")).otherwise(F.col("outer")) - (1 - closed),
            "opens": F.when(inside == 0, F.col("outer")).otherwise(F.col("inner")),
            "opens_in": F.when(inside == 0, F.col("inner")).otherwise(F.col("outer")),
        }
    ).drop("outer", "inner")


def _sums(marked: DataFrame) -> DataFrame:
    """One row per split, summed before anything is moved. Where no piece leaves a string
    open (``odd`` is 0) each piece begins like its split. ``flat``: each piece is one object
    then, but for the split's last one, which may be what follows the last object."""
    plain = F.col("outer") == 1
    sums = marked.groupBy(*SPLIT).agg(
        F.min("_order").alias("_begin"),
        F.max("quotes").alias("odd"),
        F.sum("quotes").alias("quotes"),
        F.sum(F.col("outer") - 1).alias("grown"),
        F.sum("inner").alias("grown_in"),
        F.count_if(~plain).alias("_unlike"),
        F.max_by("outer", "_order").alias("_last"),
    )
    flat = (F.col("odd") == 0) & (F.col("_unlike") == F.when(F.col("_last") == 0, 1).otherwise(0))
    return sums.withColumn("flat", flat).drop("_unlike", "_last")


def _begun(sums: DataFrame) -> DataFrame:
    """How each split begins: ``_inside`` a string or not, and objects open, ``_depth``; and
    whether it is ``plain``, so that each object in it is a record."""
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    begun = sums.withColumn("_inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    grown = F.when(F.col("_inside") == 0, F.col("grown")).otherwise(F.col("grown_in"))
    begun = begun.withColumn("_grown", grown).withColumn("_depth", F.coalesce(F.sum("_grown").over(before), F.lit(0)))
    plain = F.col("flat") & (F.col("_inside") == 0) & (F.col("_depth") == 0)
    return begun.select(*SPLIT, "_begin", "_inside", "_depth", "odd", plain.alias("plain"))


def _placed(counted: DataFrame) -> DataFrame:
    """Pieces of records: their place ``_at``, whether they are a record (``alone``), and
    ``_first``, the place of their record's first piece if it is in the same split."""
    inside = F.col("_inside") == 1
    upto = Window.partitionBy(*SPLIT).orderBy("_order")
    rows = counted.select(
        "value", *SPLIT, "_order",
        (F.col("_block") + F.row_number().over(upto) - 1).alias("_at"),
        F.when(inside, F.col("grown_in")).otherwise(F.col("grown")).alias("_grown"),
        F.when(inside, F.col("opens_in")).otherwise(F.col("opens")).alias("_opens"),
        "_depth",
    )
    after = F.col("_depth") + F.sum("_grown").over(upto.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("_after", after).withColumn("_before", F.col("_after") - F.col("_grown"))
    starts = (F.col("_before") == 0) & (F.col("_opens") > 0)
    first = F.max(F.when(starts, F.col("_at"))).over(upto.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.where(starts | (F.col("_before") > 0))
    return rows.select("value", *SPLIT, "_at", (starts & (F.col("_after") == 0)).alias("alone"), first.alias("_first"), "_after")


def _joined(rows: DataFrame) -> DataFrame:
    """The texts of records, put together from the pieces that ``_placed`` gives."""
    # What a split leaves open goes on in the next one with a piece of that record.
    last = F.max(F.struct("_at", "_first", "_after")).alias("last")
    tails = rows.groupBy(*SPLIT).agg(last).select(
        *SPLIT, F.when(F.col("last._after") > 0, F.col("last._first")).alias("_open")
    )
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    tails = tails.select(*SPLIT, F.last("_open", ignorenulls=True).over(before).alias("_left"))
    some = rows.where(~F.col("alone"))
    heads = some.where("_first is null").join(tails, SPLIT).select("value", "_file", "_at", F.col("_left").alias("_first"))
    some = some.where("_first is not null").select("value", "_file", "_at", "_first").unionByName(heads)
    joined = some.groupBy("_file", "_first").agg(F.array_sort(F.collect_list(F.struct("_at", "value"))).alias("pieces"))
    whole = joined.select("_file", F.col("_first").alias("_at"), F.array_join("pieces.value", "}").alias("value"))
    return rows.where("alone").select("_file", "_at", "value").unionByName(whole)


def read_arrays(spark: SparkSession, paths: str | Sequence[str], positioned: bool = False, schema: StructType = RAW) -> DataFrame:
    """The objects of JSON files, each a top-level array of objects, an object, or lines of
    either, under ``schema``; absent fields are NULL. Files of any size are read in splits,
    those compressed in a way that cannot be split as a whole.

    With ``positioned``, ``_file`` and ``_at`` give each record's place; places in a file
    rise, with gaps. An empty array has no rows. Text that is no JSON object gives a row of
    NULLs, as in Spark's own reader.
    """
    pieces = _pieces(spark, [paths] if isinstance(paths, str) else paths)
    marked = _marked(pieces)
    sums = stage(_sums(marked), "json-splits").df
    begun = _begun(sums)
    odd, rest = begun.agg(F.max("odd") == 1, F.bool_or(~F.col("plain"))).first()
    if odd:
        # Within these splits the pieces begin in different ways.
        kinked = _counted(marked.join(sums.where("odd = 1").select(*SPLIT), SPLIT, "left_semi"))
        kinked = kinked.groupBy(*SPLIT).agg(F.sum("grown").alias("grown"), F.sum("grown_in").alias("grown_in"))
        told = sums.where("odd = 1").drop("grown", "grown_in").join(kinked, SPLIT)
        begun = stage(_begun(sums.where("odd = 0").unionByName(told)), "json-begun").df
    # Records of plain splits are parsed where they are; no piece of them is moved or kept.
    opens = F.contains(F.substring_index(_bare(), '"', 1), F.lit("{")) | (_outer(_bare()) > 0)
    alone = pieces.where(opens)
    if rest or positioned:
        alone = alone.join(begun.where("plain").select(*SPLIT, "_begin"), SPLIT)
        alone = alone.withColumn("_at", F.col("_block") + F.col("_order") - F.col("_begin"))
    texts = alone.select("value", *(("_file", "_at") if rest or positioned else ()))
    if rest:
        others = marked.join(begun.where(~F.col("plain")).select(*SPLIT, "_inside", "_depth"), SPLIT)
        rows = stage(_placed(_counted(others)), "json-pieces").df
        texts = texts.unionByName(_joined(rows))
    body = F.concat(F.expr("substring(value, instr(value, '{'))"), F.lit("}"))
    records = texts.withColumn("r", F.from_json(body, schema))
    return records.select("r.*", *(("_file", "_at") if positioned else ()))
