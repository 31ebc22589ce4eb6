"""Field profiles, data dictionaries, row counts and content fingerprints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..staging import stage

# The names under which value types are reported.
TYPE_NAMES = {
    "string": "str",
    "tinyint": "int",
    "smallint": "int",
    "int": "int",
    "bigint": "int",
    "float": "float",
    "double": "float",
    "boolean": "bool",
}

LIST_LIMIT = 20


def _type_name(simple: str) -> str:
    return TYPE_NAMES.get(simple, "float" if simple.startswith("decimal") else simple.removesuffix("_ntz"))


def profile_fields(df: DataFrame, position: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per field: type, total, nulls (NULL or ''), cardinality, first example in
    the order of ``position``, and the sorted values where there are at most 20."""
    columns = list(columns or df.columns)
    cells = [
        F.struct(F.lit(c).alias("campo"), F.nullif(F.col(c).cast("string"), F.lit("")).alias("valor"))
        for c in columns
    ]
    types = dict(df.dtypes)
    named = F.create_map(*[F.lit(x) for c in columns for x in (c, _type_name(types[c]))])
    described = _profile(df.select(F.col(position).alias("_at"), F.inline(F.array(*cells))))
    return _shown(described.withColumn("tipo", named[F.col("campo")]))


def field_sketches(df: DataFrame, position: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A row per field from which profiles of any union of tables are merged: counts, a
    sketch of the distinct values, the first example, and the values where there are at
    most 20. One pass that combines to a row per field and task; only the values of
    fields whose sketch is small, for which it is exact, are then listed in another."""
    columns = list(columns or df.columns)
    types = dict(df.dtypes)
    cells = F.array(*[F.struct(F.lit(c).alias("campo"), F.nullif(F.col(c).cast("string"), F.lit("")).alias("valor")) for c in columns])
    entries = df.select(F.col(position).alias("_at"), F.inline(cells))
    filled = F.col("valor").isNotNull()
    fields = entries.groupBy("campo").agg(
        F.count(F.lit(1)).alias("total"),
        F.count("valor").alias("preenchidos"),
        F.hll_sketch_agg("valor").alias("esboco"),
        F.min(F.when(filled, F.struct("_at", "valor")))["valor"].alias("exemplo"),
    )
    fields = stage(fields, "sketches").df
    small = fields.where(F.hll_sketch_estimate("esboco") <= LIST_LIMIT)
    listed = entries.where(filled).join(F.broadcast(small.select("campo")), "campo", "left_semi").groupBy("campo", "valor").count()
    lists = listed.groupBy("campo").agg(F.sort_array(F.collect_list("valor")).alias("valores"))
    listed_or_none = F.when(F.hll_sketch_estimate("esboco") <= LIST_LIMIT, F.coalesce("valores", F.array().cast("array<string>")))
    named = F.create_map(*[F.lit(x) for c in columns for x in (c, _type_name(types[c]))])
    joined = fields.join(F.broadcast(lists), "campo", "left")
    return joined.select("campo", named[F.col("campo")].alias("tipo"), "total", "preenchidos", "esboco", "exemplo", listed_or_none.alias("valores"))


def merged_profile(sketches: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """The profile of the union of what was sketched, in the columns of
    ``profile_fields``. Cardinalities are exact where there are at most 20 values, else
    estimates within a few hundredths. The example is that of the first table in the
    columns ``order`` that has one; the type that of the most values."""
    filled = F.col("preenchidos") > 0
    listed = F.array_sort(F.array_distinct(F.flatten(F.collect_list("valores"))))
    merged = sketches.groupBy("campo").agg(
        F.max_by("tipo", F.struct("preenchidos", "tipo")).alias("tipo"),
        F.sum("total").alias("total"),
        F.sum("preenchidos").alias("_filled"),
        F.hll_sketch_estimate(F.hll_union_agg("esboco")).alias("_estimate"),
        F.min_by(F.when(filled, F.col("exemplo")), F.when(filled, F.struct(*order, "exemplo"))).alias("exemplo"),
        F.when(F.every(F.col("valores").isNotNull()), listed).alias("_listed"),
    )
    few = F.col("_listed").isNotNull() & (F.size("_listed") <= LIST_LIMIT)
    return _shown(
        merged.withColumns(
            {
                "cardinalidade": F.when(F.col("_listed").isNotNull(), F.size("_listed")).otherwise(F.col("_estimate")).cast("long"),
                "valores_unicos": F.when(few, F.col("_listed")),
            }
        )
    )


def profile_documents(documents: DataFrame, body: str = "v", position: str = "_at") -> DataFrame:
    """The same profile of JSON objects held in a VARIANT column. Each value has a type
    of its own here, of which the most frequent counts, and a field that an object lacks
    is null in it."""
    cells = documents.select(F.col(position).alias("_at"), F.col(body).alias("_body"))
    fields = cells.lateralJoin(
        documents.sparkSession.tvf.variant_explode(F.col("_body").outer())
    ).select(
        "_at",
        F.col("key").alias("campo"),
        F.lower(F.schema_of_variant("value")).alias("_type"),
        F.nullif(F.col("value").cast("string"), F.lit("")).alias("valor"),
    )
    total = documents.agg(F.count(F.lit(1))).scalar()
    kinds = fields.where("valor is not null").groupBy("campo", "_type").agg(F.count(F.lit(1)).alias("_n"))
    named = F.when(F.col("_type").startswith("decimal"), "float")
    for simple, name in TYPE_NAMES.items():
        named = named.when(F.col("_type") == simple, name)
    kinds = kinds.groupBy("campo", named.otherwise(F.col("_type")).alias("tipo")).agg(F.sum("_n").alias("_n"))
    modal = kinds.groupBy("campo").agg(F.min_by("tipo", F.struct(-F.col("_n"), F.col("tipo"))).alias("tipo"))
    described = _profile(fields.select("_at", "campo", "valor")).join(modal, "campo", "left")
    return _shown(described.withColumn("total", total))


def _profile(entries: DataFrame) -> DataFrame:
    """Counts of (_at, campo, valor) rows, per field, and the values of the fields with few.

    Equal values meet first, so a hot value is one row per task before a field is summed
    up. The counts, one row per field, are written out; only then are the values listed,
    and only of fields known to have few, so no list can grow.
    """
    values = entries.groupBy("campo", "valor").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_at"))
    filled = F.col("valor").isNotNull()
    counts = values.groupBy("campo").agg(
        F.sum("_n").alias("total"),
        F.sum(F.when(filled, F.col("_n")).otherwise(0)).alias("_filled"),
        F.count("valor").alias("cardinalidade"),
        F.min(F.when(filled, F.struct("_at", "valor")))["valor"].alias("exemplo"),
    )
    fields = stage(counts, "profile").df
    few = F.broadcast(fields.where(F.col("cardinalidade") <= LIST_LIMIT).select("campo"))
    listed = entries.where(filled).join(few, "campo", "left_semi").groupBy("campo", "valor").count()
    lists = listed.groupBy("campo").agg(F.sort_array(F.collect_list("valor")).alias("valores_unicos"))
    return fields.join(F.broadcast(lists), "campo", "left")


def _shown(described: DataFrame) -> DataFrame:
    some = F.col("_filled") > 0
    return described.select(
        "campo",
        F.when(some, F.col("tipo")).otherwise("null").alias("tipo"),
        "total",
        (F.col("total") - F.col("_filled")).alias("nulos"),
        "cardinalidade",
        "exemplo",
        F.when(some, F.col("valores_unicos")).otherwise(F.array().cast("array<string>")).alias("valores_unicos"),
    )


def profile_document(profile: DataFrame, rows: int, fields: int, source: str, year: int) -> DataFrame:
    """The profile as one JSON-ready row. A field list is as long as a row is wide."""
    return profile.agg(
        F.sort_array(F.collect_list(F.struct("campo", *[c for c in profile.columns if c != "campo"]))).alias("campos")
    ).select(
        F.lit(source).alias("arquivo_origem"),
        F.lit(year).cast("long").alias("ano"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("gerado_em"),
        F.lit(rows).cast("long").alias("total_registros"),
        F.lit(fields).cast("long").alias("total_campos"),
        "campos",
    )


# Type names of the published dictionary.
SQL_TYPES = {"string": "VARCHAR", "int": "INTEGER"}


def data_dictionary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, column_name, column_type, null, ...) from the schemas alone; no job runs."""
    rows = [
        (table, i, f.name, SQL_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString().upper()), "YES")
        for table, df in tables.items()
        for i, f in enumerate(df.schema)
    ]
    spark = next(iter(tables.values())).sparkSession
    listed = spark.createDataFrame(
        rows, "table_name string, position int, column_name string, column_type string, null string"
    )
    empty = F.lit(None).cast("string")
    return listed.withColumns({"key": empty, "default": empty, "extra": empty})


def observed(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """``df`` that counts its rows while something else consumes it."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias(name)), seen


def fingerprint(df: DataFrame) -> DataFrame:
    """Content fingerprint that depends on the rows but not on their order or files: the
    row count and two sums of 60 bits each of the rows' SHA-256, hashed. A decimal holds
    the sums of more rows than there can be."""
    row = F.sha2(F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"}), 256)

    def total(start: int) -> Column:
        number = F.conv(F.substring(row, start, 15), 16, 10).cast("decimal(38,0)")
        return F.coalesce(F.sum(number), F.lit(0)).cast("decimal(38,0)")

    sums = df.agg(F.count(F.lit(1)).alias("registros"), total(1).alias("_a"), total(16).alias("_b"))
    return sums.select("registros", F.sha2(F.concat_ws("/", "registros", "_a", "_b"), 256).alias("hash"))
