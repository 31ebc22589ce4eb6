"""One callable per operator or result set: (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import lookups, money, text
from ..operators import contract as C
from ..operators import dedupe, joins, ordered, profile, statistics
from ..plans import cleaning, features, mart, run, serving
from ..sources import landing, layers as store, raw
from ..sources.arrays import read_arrays
from ..staging import forget_shuffles, fresh_path, published, remove, scratch, stage
from ..streaming import landing as streaming
from .binding import POSITION, RULES, layers, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(make: Query, name: str | None = None) -> Query:
    QUERIES[name or make.__name__] = make
    return make


# ---- functions -----------------------------------------------------------------------


@query
def money_parse(spark, folder):
    """Order totals written as Brazilian text and read back; a status is no amount."""
    written = money.format_number_br(F.col("o_totalprice"), 2)
    status = F.col("o_orderstatus")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        written.alias("texto"),
        money.money_or_zero(written).cast("double").alias("valor_zero"),
        money.money_or_null(F.concat(F.lit(" "), written, F.lit(" "))).cast("double").alias("valor_nulo"),
        money.money_or_zero(status).cast("double").alias("status_zero"),
        money.money_or_null(status).cast("double").alias("status_nulo"),
        money.bad_money(status).alias("status_invalido"),
        money.money_or_zero(F.nullif(status, status)).cast("double").alias("ausente_zero"),
        money.format_money_br(F.col("o_totalprice")).alias("moeda"),
    )


@query
def percent_format(spark, folder):
    rate = F.col("l_discount").cast("double") * 1000
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", money.format_pct_br(rate, 1).alias("pct")
    )


@query
def text_normalise(spark, folder):
    padded = F.concat(F.lit(" \t"), F.replace("p_name", F.lit(" "), F.lit("'")), F.lit("-"), "p_type", F.lit(" \n"))
    return table(spark, folder, "part").select(
        "p_partkey",
        text.title_case(text.strip(padded)).alias("titulo"),
        text.word_case(F.concat_ws(" ", "p_type", "p_name", "p_brand")).alias("palavras"),
        text.upper_strip(padded).alias("maiusculas"),
        F.trim(F.concat(F.lit("  "), "p_name", F.lit(" \t"))).alias("aparado"),
        F.coalesce(F.nullif("p_type", F.lit("PROMO")), F.lit(S.NO_SUBFUNCTION)).alias("padrao"),
    )


@query
def state_lookup(spark, folder):
    """Customers placed in Brazilian states by nation number: place -> state -> region."""
    names = F.array(*[F.lit(n) for n in S.STATE_CODES], F.lit(S.NATIONAL))
    place = F.concat(F.element_at(names, (F.col("c_custkey") % 28 + 1).cast("int")), F.lit(" (UF)"))
    loose = F.concat(F.lower(text.fold_accents(F.substring_index(place, " (", 1))), F.lit(" (estado)"))
    return table(spark, folder, "customer").select(
        "c_custkey",
        place.alias("lugar"),
        lookups.state_of_place(place).alias("uf"),
        lookups.state_of_place_loose(loose).alias("uf_sem_acento"),
        lookups.region_of_state(lookups.state_of_place(place)).alias("regiao"),
    )


@query
def place_to_region(spark, folder):
    """Region by lookup and by join, which must agree."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    by_join = nation.join(region, nation.n_regionkey == region.r_regionkey)
    uf = RULES.state_of(F.col("n_name"))
    return (
        table(spark, folder, "customer")
        .join(by_join, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select("c_custkey", "n_name", uf.alias("uf"), RULES.region_of(uf).alias("regiao"), "r_name")
    )


@query
def theme_lookup(spark, folder):
    function = text.title_case(F.col("o_orderpriority"))
    return table(spark, folder, "orders").select(
        "o_orderkey",
        function.alias("funcao"),
        RULES.theme_of(function).alias("area_tematica"),
        lookups.theme_of_function(function).alias("area_publicada"),
    )


@query
def year_filter(spark, folder):
    orders = table(spark, folder, "orders").withColumn("ano", F.year("o_orderdate").cast("long"))
    return cleaning.in_window(orders, RULES).select("o_orderkey", "ano")


@query
def period_case(spark, folder):
    year = F.year("o_orderdate").cast("long")
    return table(spark, folder, "orders").select(
        "o_orderkey", year.alias("ano"), RULES.period_of(year).alias("periodo")
    )


@query
def type_simplify(spark, folder):
    words = {"Individual": "RING", "Comissão": "red", "Bancada": "Bolt"}
    return table(spark, folder, "part").select(
        "p_partkey", "p_name", lookups.simple_type(F.col("p_name"), words).alias("tipo_simplificado")
    )


@query
def rates_and_flags(spark, folder):
    df = layers(spark, folder).records
    paid, committed = F.col("valorPago"), F.col("valorEmpenhado")
    rate = money.execution_rate(paid, committed)
    return mart.published(
        df.select(
            "codigoEmenda",
            rate.alias("taxa_execucao_pct"),
            F.round(money.execution_rate(paid, committed, None), 6).alias("taxa_sem_arredondar"),
            (F.col("valorRestoInscrito") - F.col("valorRestoCancelado")).alias("restos_liquidos"),
            money.is_showcase(paid, committed, RULES.showcase_below).alias("emenda_vitrine"),
            money.is_showcase_for_display(committed, rate).alias("vitrine_painel"),
            F.round(money.ratio(paid, F.col("valorRestoCancelado")), 3).alias("razao"),
        )
    )


# ---- sources and sinks ---------------------------------------------------------------


@query
def parquet_scan_count(spark, folder):
    """Rows of each table: counted in a view, and observed during a write."""
    parts = []
    for name in ("customer", "orders", "lineitem"):
        store.register_table(spark, f"{folder}/{name}.parquet", f"scan_{name}")
        counted = spark.sql(f"SELECT '{name}' AS tabela, count(*) AS linhas FROM scan_{name}")
        seen = stage(table(spark, folder, name), f"count_{name}").rows
        parts.append(counted.withColumn("observadas", F.lit(seen).cast("long")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _as_documents(records: DataFrame, *others: str) -> DataFrame:
    """Records with their amounts as Brazilian text, to the cent, and ``others`` as they are."""
    amounts = [money.format_number_br(F.round(c, 2), 2).alias(c) for c in S.MONEY_COLUMNS]
    return records.select(*S.RAW_COLUMNS[:9], *amounts, *others)


@query
def json_roundtrip(spark, folder):
    """Records written as JSON in two column sets and read back by name."""
    records = layers(spark, folder).records
    texts = _as_documents(records)
    path = fresh_path(spark, "json")
    early = F.col("ano") < 1998
    texts.where(early).drop(*S.MONEY_COLUMNS[3:]).write.json(f"{path}/a")
    texts.where(~early).drop("subfuncao").write.json(f"{path}/b")
    both = raw.read_json(spark, [f"{path}/a", f"{path}/b"], lines=True)
    return mart.published(cleaning.typed(both, "keep").select(*S.RAW_COLUMNS))


@query
def json_pages(spark, folder):
    """Orders landed as one JSON array per line."""
    record = F.struct(
        F.col("o_orderkey").cast("string").alias("codigoEmenda"),
        F.year("o_orderdate").alias("ano"),
        F.col("o_orderstatus").alias("subfuncao"),
    )
    path = fresh_path(spark, "pages")
    table(spark, folder, "orders").select(F.to_json(F.array(record))).write.text(path)
    return raw.read_json(spark, path, lines=True).select("codigoEmenda", "ano", "subfuncao")


@query
def parquet_roundtrip(spark, folder):
    """Two appended loads as Snappy, then staged as Zstd and reused."""
    orders = table(spark, folder, "orders")
    path = fresh_path(spark, "orders")
    early = F.col("o_orderdate") < "1998-01-01"
    for load, rows in enumerate((orders.where(early), orders.where(~early))):
        rows.withColumn("ingest_id", F.lit(load)).write.mode("append").partitionBy("ingest_id").option(
            "compression", "snappy"
        ).parquet(path)
    landed = spark.read.parquet(path).drop("ingest_id")
    once = store.staged(landed, f"{path}-staged")
    again = store.staged(once.limit(0), f"{path}-staged")
    return again.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@query
def lookup_register(spark, folder):
    """A small local table registered and joined; what it lacks gets a default."""
    rows = [(name, theme) for name, theme in (("1-URGENT", "Social"), ("2-HIGH", "Social"), ("5-LOW", "Segurança"))]
    local = spark.createDataFrame(rows, "o_orderpriority string, area string")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return orders.join(F.broadcast(local), "o_orderpriority", "left").withColumn(
        "area", F.coalesce("area", F.lit("NA"))
    )


def _arrays(
    rows: DataFrame,
    least: int = 16,
    rows_per_lot: int = 500_000,
    rows_per_task: int = 60_000,
    shape: Callable = lambda dealt: dealt,
) -> DataFrame:
    """One JSON array for each year and lot of ``rows`` (``lote``, ``value``), of documents
    as ``shape`` makes them of rows. There are more lots of more rows, so that an array is
    never a growing share of them, and more tasks, which have few arrays in memory each; a
    task takes whole arrays, and rows are moved as they are."""
    count = rows.count()
    lots = max(least, -(-count // rows_per_lot))
    lot = F.pmod(F.xxhash64("codigoEmenda"), F.lit(lots)).alias("lote")
    dealt = rows.select("*", lot).repartition(max(lots, -(-count // rows_per_task)), "ano", "lote")
    documents = shape(dealt)
    one = F.struct(*[c for c in documents.columns if c != "lote"])
    arrays = documents.groupBy("ano", "lote").agg(F.to_json(F.collect_list(one)).alias("value"))
    return arrays.select("lote", "value")


@query
def layer_fallback(spark, folder):
    """The serving columns from the mart, from trusted alone and from raw JSON alone, as
    lines and as documents of one array each. What a layer was read from is removed before
    the next one is written, and JSON is compressed, as its text is many times the tables."""
    built = layers(spark, folder)
    path = fresh_path(spark, "layers")
    parts = []

    def measure(layer: str, *places: str, lines: bool = False) -> None:
        found = store.best_layer(spark, *(f"{path}/{place}" for place in places), RULES, lines=lines)
        figures = found.agg(
            F.count(F.lit(1)).alias("linhas"),
            money.exact_sum(F.col("valorEmpenhado")).alias("empenhado"),
            F.count_if("emenda_vitrine").alias("vitrines"),
            F.count_distinct("uf").alias("ufs"),
        ).select(F.lit(layer).alias("camada"), "*")
        parts.append(stage(figures, "layer_figures", keep=True).df)
        forget_shuffles(spark)

    records = built.records  # the trusted table is made from these, too
    forget_shuffles(spark)
    trusted = built.trusted
    forget_shuffles(spark)
    try:
        with scratch(spark):
            store.write_tables(mart.build(trusted, RULES).tables(), f"{path}/mart")
        forget_shuffles(spark)
        store.write_tables({"t": mart.published(trusted)}, path)
        measure("mart", "mart", "t.parquet", "none")
        remove(spark, f"{path}/mart")
        measure("trusted", "none", "t.parquet", "none")
        remove(spark, f"{path}/t.parquet")
        packed = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
        _as_documents(records).write.options(maxRecordsPerFile=500_000, **packed).json(f"{path}/raw")
        measure("raw", "none", "none", "raw", lines=True)
        remove(spark, f"{path}/raw")
        arrays = _arrays(records, shape=lambda dealt: _as_documents(dealt, "lote"))
        arrays.write.partitionBy("lote").options(**packed).text(f"{path}/arrays")
        forget_shuffles(spark)
        with scratch(spark):
            measure("raw arrays", "none", "none", "arrays")
    finally:
        remove(spark, path)
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query
def filename_parse(spark, folder):
    stamp = F.date_format("o_orderdate", "yyyyMMdd_HHmmss")
    name = F.when(
        F.col("o_orderstatus") == "P", F.concat(F.lit("emendas_"), F.year("o_orderdate"), F.lit("_sample.json"))
    ).otherwise(F.concat(F.lit("emendas_"), F.year("o_orderdate"), F.lit("_"), stamp, F.lit(".json")))
    name = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("outro.json")).otherwise(name)
    return table(spark, folder, "orders").select("o_orderkey", name.alias("arquivo")).withColumns(
        raw.parse_name(F.col("arquivo"))
    )


# ---- ingestion control ---------------------------------------------------------------


def _loads(spark, folder):
    """One raw file per year and order status, stamped with its latest order date."""
    orders = table(spark, folder, "orders")
    year = F.year("o_orderdate").cast("long")
    files = orders.groupBy(year.alias("_ano"), "o_orderstatus").agg(F.max("o_orderdate").alias("_at"))
    stamp = F.concat(F.date_format("_at", "yyyyMMdd_"), F.lpad(F.conv(F.hex("o_orderstatus"), 16, 10), 6, "0"))
    name = F.concat(F.lit("emendas_"), F.col("_ano"), F.lit("_"), stamp, F.lit(".json"))
    return files.select(F.concat(F.lit("/raw/"), name).alias("path"), name.alias("arquivo"), "_ano", "o_orderstatus")


@query
def snapshot_select(spark, folder):
    """Current file per year by ledger; a ledger of lost files falls back to the names."""
    files = _loads(spark, folder)
    recorded = files.where("o_orderstatus = 'O'").select(
        F.col("_ano").alias("ano"), F.col("path").alias("arquivo"), F.lit("2024-01-01").alias("coletado_em")
    )
    lost = recorded.withColumn("arquivo", F.concat("arquivo", F.lit(".bak")))
    listing = files.select("path", "arquivo")
    with_ledger = raw.select_current(listing, recorded).withColumn("caso", F.lit("ledger"))
    without = raw.select_current(listing, lost).withColumn("caso", F.lit("perdido"))
    both = with_ledger.unionByName(without)
    return both.withColumn("ano", F.col("ano").cast("long"))


@query
def idempotent_load(spark, folder):
    """Orders of months that no completed load covers yet."""
    orders = table(spark, folder, "orders").withColumn("mes", F.date_format("o_orderdate", "yyyyMM"))
    ledger = orders.where(F.col("o_orderdate") < "1999-06-15").groupBy("mes").agg(
        F.count(F.lit(1)).alias("registros")
    )
    fresh = landing.pending(orders, ledger, key="mes").withColumn("forcado", F.lit(False))
    forced = landing.pending(orders, ledger, force=True, key="mes").withColumn("forcado", F.lit(True))
    both = fresh.unionByName(forced)
    return both.groupBy("forcado", "mes").agg(F.count(F.lit(1)).alias("registros"))


@query
def page_completeness(spark, folder):
    """Years as collections, months as pages."""
    orders = table(spark, folder, "orders")
    pages = orders.select(
        F.year("o_orderdate").cast("long").alias("ano"), F.month("o_orderdate").cast("long").alias("pagina")
    ).where(~((F.col("ano") == 1997) & (F.col("pagina") == 5)))
    return raw.page_completeness(pages)


@query
def land_and_read(spark, folder):
    """All years landed one by one, some of them offered again, one by force; the current
    loads read back."""
    orders = table(spark, folder, "orders").withColumn("ano", F.year("o_orderdate").cast("long"))
    path = fresh_path(spark, "landing")
    years = sorted(row["ano"] for row in orders.select("ano").distinct().collect())
    for year in years:
        landing.land(orders.where(F.col("ano") == year), path, year, "20240101_000000", profile=False)
    for year in years[::2]:  # landed before: nothing happens
        landing.land(orders.where("false"), path, year, "20240102_000000", profile=False)
    landing.land(orders.where("ano = 1998"), path, 1998, "20240103_000000", force=True, profile=False)
    known = orders.drop("ano").schema.add("ano", "long").add("ingest_id", "string")
    return landing.read_landed(spark, path, schema=known).select("o_orderkey", "ano", "ingest_id")


@query
def forced_reload(spark, folder):
    """A sample landed first, then the real load by force: the names of the loads sort the
    other way, the times of the loads count. All years read back, two of them chosen."""
    orders = table(spark, folder, "orders").withColumn("ano", F.year("o_orderdate").cast("long"))
    path = fresh_path(spark, "reload")
    for year in (1997, 1998):
        rows = orders.where(F.col("ano") == year)
        landing.land(rows.where("o_orderstatus = 'P'"), path, year, f"emendas_{year}_sample", profile=False)
        landing.land(rows, path, year, f"emendas_{year}_20240101_000000", force=True, profile=False)
    landing.land(orders.where("ano = 1996"), path, 1996, "emendas_1996_sample", profile=False)
    current = landing.read_landed(spark, path, years=[1997, 1998])
    return current.select("o_orderkey", F.col("ano").cast("long").alias("ano"), "ingest_id")


def _yearly_loads(spark, folder):
    """Orders as loads by year, printed the same way by any engine, and the years."""
    orders = table(spark, folder, "orders")
    rows = orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.floor(F.col("o_totalprice") * 100 + 0.5).alias("centavos"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("data"),
        "o_orderpriority",
        F.year("o_orderdate").cast("long").alias("ano"),
    )
    return rows, sorted(row["ano"] for row in rows.select("ano").distinct().collect())


@query
def failed_reload(spark, folder):
    """Every year is landed, and landed again by force under the same name with rows that
    cannot be computed to their end, and with none: the loads stay, and no entry is added."""
    rows, years = _yearly_loads(spark, folder)
    path = fresh_path(spark, "failed")
    known = rows.drop("ano").schema.add("ano", "long").add("ingest_id", "string")
    for year in years:
        batch = rows.where(F.col("ano") == year)
        landing.land(batch, path, year, "carga", profile=False)
        last = batch.agg(F.max("o_orderkey")).scalar()
        broken = batch.withColumn("data", F.when(F.col("o_orderkey") == last, F.raise_error(F.lit("lost"))).otherwise(F.col("data")))
        for bad in (broken, batch.where("false")):
            try:
                landing.land(bad, path, year, "carga", force=True, profile=False)
            except (landing.EmptyLoad, PySparkException):
                continue
            raise AssertionError("a load that fails was landed")
    entries = landing.read_ledger(spark, path).groupBy("ano").agg(F.count(F.lit(1)).alias("entradas"))
    return landing.read_landed(spark, path, schema=known).drop("ingest_id").join(F.broadcast(entries), "ano")


@query
def ledger_entries(spark, folder):
    """What the ledger tells of every load: each year landed, every second one again by
    force without its open orders."""
    rows, years = _yearly_loads(spark, folder)
    path = fresh_path(spark, "ledger")
    for year in years:
        batch = rows.where(F.col("ano") == year)
        landing.land(batch, path, year, f"a{year}", profile=False)
        if year % 2 == 0:
            landing.land(batch.where("o_orderstatus <> 'O'"), path, year, f"b{year}", mode="amostra", force=True, profile=False)
    ledger = landing.read_ledger(spark, path)
    name = F.regexp_extract("arquivo", r"/ano=(\d+/ingest_id=\w+)/", 1)
    current = landing.current_entries(ledger).select("arquivo", F.lit(True).alias("atual"))
    known = ledger.join(F.broadcast(current), "arquivo", "left")
    return known.select("ano", name.alias("carga"), "hash", "registros", "modo", F.coalesce("atual", F.lit(False)).alias("atual"))


@query
def empty_load_gate(spark, folder):
    """Loads of urgent orders of odd years only: those without rows are refused."""
    rows, years = _yearly_loads(spark, folder)
    path = fresh_path(spark, "empty")
    found = []
    for year in years:
        batch = rows.where((F.col("ano") == year) & (F.col("ano") % 2 == 1) & (F.col("o_orderpriority") == "1-URGENT"))
        try:
            landing.land(batch, path, year, "urgentes", profile=False)
            found.append((year, False))
        except landing.EmptyLoad:
            found.append((year, True))
    gates = spark.createDataFrame(found, "ano long, recusada boolean")
    ledger = landing.read_ledger(spark, path).select("ano", "registros")
    return gates.join(F.broadcast(ledger), "ano", "left").select("ano", "recusada", F.coalesce("registros", F.lit(0).cast("long")).alias("registros"))


@query
def landed_profile(spark, folder):
    """The profile documents that loads leave beside them, read back."""
    rows, years = _yearly_loads(spark, folder)
    path = fresh_path(spark, "described")
    for year in years:
        landing.land(rows.where(F.col("ano") == year), path, year, "carga", "o_orderkey")
    cells = "array<struct<campo string, tipo string, total long, nulos long, cardinalidade long, exemplo string, valores_unicos array<string>>>"
    schema = f"arquivo_origem string, ano long, gerado_em string, total_registros long, total_campos long, campos {cells}"
    written = spark.read.schema(schema).option("recursiveFileLookup", True).json(f"{path}/perfil")
    known = landing.read_ledger(spark, path).select(F.col("arquivo").alias("arquivo_origem"), F.col("registros"))
    documents = written.join(F.broadcast(known), "arquivo_origem")
    return _listed(documents.select("ano", "registros", "total_registros", "total_campos", F.inline("campos")))


@query
def merged_profile(spark, folder):
    """Every year landed, one of them twice, and the loads' sketches merged. Where there are
    many values, whether the estimate of their number is within five hundredths."""
    rows, years = _yearly_loads(spark, folder)
    path = fresh_path(spark, "sketches")
    for year in years:
        landing.land(rows.where(F.col("ano") == year), path, year, "carga", "o_orderkey", exact=False)
    landing.land(rows.where("ano = 1997 and o_orderstatus = 'F'"), path, 1997, "nova", "o_orderkey", force=True, exact=False)
    current = rows.where("ano <> 1997 or o_orderstatus = 'F'")
    counts = current.agg(*[F.count_distinct(c).alias(c) for c in current.columns if c != "ano"])
    exact = counts.unpivot([], counts.columns, "campo", "_exact")
    profiled = landing.read_profile(spark, path).join(F.broadcast(exact), "campo")
    near = F.abs(F.col("cardinalidade") - F.col("_exact")) <= 0.05 * F.col("_exact")
    few = F.when(F.col("_exact") <= profile.LIST_LIMIT, F.col("cardinalidade"))
    return _listed(profiled.withColumns({"perto": near, "cardinalidade": few}).drop("_exact"))


@query
def page_stream(spark, folder):
    """Months as page files, the first half and later the second: the stream takes in what
    is new, and lands each year when its twelve pages are there."""
    path = fresh_path(spark, "page_stream")
    pages = layers(spark, folder).records.select("codigoEmenda", "ano", "funcao", "subfuncao")
    pages = pages.withColumn("pagina", F.pmod(F.col("codigoEmenda").cast("long"), F.lit(12)) + 1)
    years = [row["ano"] for row in pages.select("ano").distinct().collect()]
    for part in ("pagina <= 6", "pagina > 6"):
        pages.where(part).write.mode("append").partitionBy("pagina").json(f"{path}/pages")
        streaming.land_pages(
            spark, f"{path}/pages", f"{path}/taken", f"{path}/checkpoint", f"{path}/landed", {y: 12 for y in years}, lines=True, profile=False
        )
    landed = landing.read_landed(spark, f"{path}/landed", schema=T.StructType(list(S.RAW.fields)).add("pagina", "integer").add("ingest_id", "string"))
    return landed.select("codigoEmenda", F.col("ano").cast("long").alias("ano"), "funcao", F.col("pagina").cast("long").alias("pagina"))


@query
def staged_by_loads(spark, folder):
    """Staging reused while the loads are the same, and made anew when one has changed:
    totals before and after a year is loaded again, the first of them asked for twice."""
    rows, years = _yearly_loads(spark, folder)
    path = fresh_path(spark, "staged_loads")
    known = rows.drop("ano").schema.add("ano", "long").add("ingest_id", "string")
    for year in years:
        landing.land(rows.where(F.col("ano") == year), path, year, "a", profile=False)

    def totals(case, make=lambda df: df):
        place = store.staging_place(spark, path, f"{path}/staging")
        staged = store.staged(make(landing.read_landed(spark, path, schema=known)), place)
        return staged.groupBy("ano").agg(F.count(F.lit(1)).alias("linhas"), F.sum("centavos").alias("centavos")).withColumn("caso", F.lit(case))

    first, again = totals("antes"), totals("de novo", lambda df: df.limit(0))
    landing.land(rows.where("ano = 1997 and o_orderstatus = 'F'"), path, 1997, "b", force=True, profile=False)
    return first.unionByName(again).unionByName(totals("depois"))


@query
def page_set(spark, folder):
    """Months as pages: written as page files, read, checked for gaps, landed, read back."""
    path = fresh_path(spark, "page_set")
    record = layers(spark, folder).records.select("codigoEmenda", "ano", "funcao")
    pages = record.withColumn("pagina", F.pmod(F.col("codigoEmenda").cast("long"), F.lit(12)) + 1)
    pages.write.partitionBy("pagina").json(f"{path}/pages")
    read = raw.read_pages(spark, f"{path}/pages", lines=True)
    landing.require_complete(raw.page_completeness(read.withColumn("ano", F.lit(0))))
    landing.land(read.withColumnRenamed("ano", "exercicio"), path, 2001, "pages", "pagina", profile=False)
    landed = landing.read_landed(spark, path)
    return landed.select("codigoEmenda", F.col("exercicio").cast("long").alias("ano"), "funcao", F.col("pagina").cast("long").alias("pagina"))


@query
def json_arrays(spark, folder):
    """Orders as files of one JSON array each, read through a glob."""
    record = F.struct(
        F.col("o_orderkey").cast("string").alias("codigoEmenda"),
        F.year("o_orderdate").alias("ano"),
        F.col("o_orderstatus").alias("subfuncao"),
    )
    path = fresh_path(spark, "arrays")
    orders = table(spark, folder, "orders").withColumn("lote", F.floor(F.col("o_orderkey") / 4000))
    arrays = orders.groupBy("lote").agg(F.to_json(F.collect_list(record)).alias("value"))
    arrays.write.partitionBy("lote").text(path)
    return raw.read_json(spark, f"{path}/lote=*/*.txt").select("codigoEmenda", "ano", "subfuncao")


@query
def json_array_splits(spark, folder):
    """Orders as arrays with texts and objects that look like borders, read in splits."""
    orders = table(spark, folder, "orders")
    record = F.struct(
        F.col("o_orderkey").cast("string").alias("codigoEmenda"),
        F.year("o_orderdate").alias("ano"),
        F.concat(F.lit('}"{\\ '), "o_orderstatus", F.lit(" [{")).alias("subfuncao"),
        F.when(F.col("o_orderkey") % 3 == 0, F.struct(F.struct(F.lit("}").alias("a")).alias("b"), F.array(F.lit("]")).alias("c"))).alias("mais"),
    )
    path = fresh_path(spark, "splits")
    arrays = orders.withColumn("lote", F.floor(F.col("o_orderkey") / 40000)).groupBy("lote").agg(F.to_json(F.collect_list(record)).alias("value"))
    arrays.write.partitionBy("lote").text(path)
    return read_arrays(spark, f"{path}/lote=*/*.txt").select("codigoEmenda", "ano", "subfuncao")


@query
def publish_null_keeping(spark, folder):
    """The null-keeping run: trusted rows and quarantine as they are published."""
    path = fresh_path(spark, "null_keeping")
    counts = run.publish_trusted_and_quarantine(
        layers(spark, folder).records, POSITION[1:], f"{path}/staging", f"{path}/trusted", f"{path}/quarantine", RULES
    )
    tables = {"emendas_trusted": f"{path}/trusted", "emendas_financeiro_invalido": f"{path}/quarantine"}
    parts = []
    for name, place in tables.items():
        rows = published(spark, f"{place}/{name}.parquet").df.select("codigoEmenda", "ano", "autor", "funcao", "valorEmpenhado", "valorPago")
        parts.append(rows.withColumns({"tabela": F.lit(name), "linhas": F.lit(counts[name]).cast("long")}))
    return parts[0].unionByName(parts[1])


@query
def publish_quality(spark, folder):
    """The accounting of a published run: rows outside the years are read and counted."""
    path = fresh_path(spark, "publish")
    quality = run.publish_trusted(layers(spark, folder).records, POSITION, path, RULES)
    rows = published(spark, f"{path}/emendas_trusted.parquet").rows
    entry = {k: float(v) if k == "pct_descartado" else int(v) for k, v in quality.items()} | {"publicados": rows}
    kinds = ", ".join(f"{k} {'double' if k == 'pct_descartado' else 'long'}" for k in entry)
    return spark.createDataFrame([tuple(entry.values())], kinds)


@query
def contract_gate(spark, folder):
    """What a blocking contract reports: carry-over amounts that are no amounts, amounts
    that are too large for one, and years outside the window; and the first rows of each."""
    records = layers(spark, folder).records
    broken = records.withColumns(
        {
            "valorRestoInscrito": F.when(F.col("subfuncao") == "P", "lixo").otherwise(F.lit("1.234,50")),
            "valorRestoPago": F.when(F.col("ano") < 1995, F.lit(1e15)).otherwise(F.lit(1.0)),
        }
    )
    try:
        C.enforce(broken, cleaning.raw_contract(RULES), ["codigoEmenda"])
        found, cases = [], []
    except C.ContractViolation as error:
        found, cases = error.found, error.cases
    rows = []
    for column, rule, count in found:
        some = [f"{position}={value}" for c, r, _, position, value in cases if (c, r) == (column, rule)]
        rows.append((column, rule, count, "|".join(some)))
    return spark.createDataFrame(rows, "column string, rule string, rows long, casos string")


@query
def fingerprint(spark, folder):
    """The same lines, all their columns, in two orders have one fingerprint. Numbers of
    two places and dates are printed the same way by any engine."""
    lines = table(spark, folder, "lineitem")
    hundredths = {c: F.floor(F.col(c) * 100 + 0.5) for c, kind in lines.dtypes if kind == "double"}
    dates = {c: F.date_format(c, "yyyy-MM-dd") for c, kind in lines.dtypes if kind.startswith("timestamp")}
    lines = lines.withColumns(hundredths | dates)
    shuffled = lines.repartition("l_suppkey")
    return (
        profile.fingerprint(lines)
        .unionByName(profile.fingerprint(shuffled))
        .groupBy("registros", "hash")
        .agg(F.count(F.lit(1)).alias("vezes"))
    )


# ---- profiling, contract, quality ----------------------------------------------------


def _listed(profiled: DataFrame) -> DataFrame:
    return profiled.withColumn("valores_unicos", F.array_join("valores_unicos", "|"))


@query
def field_profile(spark, folder):
    customers = table(spark, folder, "customer").withColumn(
        "c_mktsegment", F.when(F.col("c_nationkey") == 3, "").otherwise(F.col("c_mktsegment"))
    )
    return _listed(profile.profile_fields(customers, "c_custkey"))


@query
def document_profile(spark, folder):
    """Customers written as JSON, some without a segment, profiled as documents in the
    order of their keys."""
    customers = table(spark, folder, "customer").withColumn(
        "c_mktsegment", F.when(F.col("c_nationkey") != 3, F.col("c_mktsegment"))
    )
    path = fresh_path(spark, "documents")
    customers.write.json(path)
    documents = raw.read_documents(spark, path, lines=True)
    placed = documents.withColumn("_at", F.variant_get("v", "$.c_custkey", "long"))
    return _listed(profile.profile_documents(placed))


@query
def profile_envelope(spark, folder):
    orders = table(spark, folder, "orders")
    described = profile.profile_fields(orders, "o_orderkey")
    envelope = profile.profile_document(described, orders.count(), len(orders.columns), "orders", 2001)
    fields = envelope.select("arquivo_origem", "ano", "total_registros", "total_campos", F.inline("campos"))
    return _listed(fields)


@query
def dictionary_document(spark, folder):
    """The data dictionary as the JSON documents that are written, read back."""
    path = fresh_path(spark, "dictionary")
    store.dictionary_json(profile.data_dictionary(layers(spark, folder).star.tables()), path)
    cell = "position int, column_name string, column_type string, `null` string, `key` string, `default` string, extra string"
    written = spark.read.schema(f"table_name string, columns array<struct<{cell.replace(' string', ': string').replace(' int', ': int')}>>").json(path)
    listed = written.select("table_name", F.inline("columns"))
    return listed.select("table_name", F.col("position").cast("long").alias("position"), "column_name", "column_type", "null", "key", "default", "extra")


@query
def data_dictionary(spark, folder):
    """Columns and types of the mart, with the rows that carry each column."""
    star = layers(spark, folder).star
    tables = star.tables()
    listed = profile.data_dictionary(tables).drop("key", "default", "extra")
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(name).alias("table_name"), "linhas")
        counts = one if counts is None else counts.unionByName(one)
    return listed.join(F.broadcast(counts), "table_name").withColumn("position", F.col("position").cast("long"))


@query
def contract_violations(spark, folder):
    """Counts of every kind of rule over all records."""
    status = T.StringType()
    rules = C.Contract(
        [
            C.Field("codigoEmenda", status, nullable=False),
            C.Field("ano", T.IntegerType(), nullable=False, allowed=RULES.years),
            C.Field("tipoEmenda", T.IntegerType()),
            C.Field("funcao", status, nullable=False, allowed=["1-URGENT", "2-HIGH"]),
            C.Field("subfuncao", status, money=True),
            C.Field("valorPago", S.MONEY, nullable=False),
            C.Field("inexistente", status),
        ]
    )
    return C.check(layers(spark, folder).records, rules)


@query
def quality_summary(spark, folder):
    return cleaning.discard_summary(layers(spark, folder).records, POSITION, RULES)


@query
def quality_report(spark, folder):
    return cleaning.discard_report(quality_summary(spark, folder))


@query
def discard_gate(spark, folder):
    """Whether the discard share is within the ceiling, at several ceilings."""
    summary = quality_summary(spark, folder)
    limits = F.explode(F.array(*[F.lit(x) for x in (0.1, 0.2, RULES.discard_limit)]))
    rows = summary.select("pct_descartado", limits.alias("limite"))
    row = {"pct_descartado": F.col("pct_descartado")}
    return rows.withColumn("aprovado", cleaning.passes(row, replace(RULES, discard_limit=F.col("limite"))))


@query
def quality_report_null(spark, folder):
    return cleaning.staging_report(layers(spark, folder).records, POSITION, RULES)


@query
def quality_summary_lines(spark, folder):
    """The discard accounting where copies abound: order lines as records of one code."""
    return cleaning.discard_summary(_line_records(spark, folder), ["ano", "numeroEmenda", "valorEmpenhado"], RULES)


def _line_records(spark, folder):
    """Lines as records with the order as their code, so most codes repeat."""
    price = F.col("l_extendedprice").cast(S.MONEY)
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("codigoEmenda"),
        F.year("l_shipdate").cast("long").alias("ano"),
        F.col("l_linestatus").alias("tipoEmenda"),
        F.col("l_suppkey").cast("string").alias("autor"),
        F.col("l_suppkey").cast("string").alias("nomeAutor"),
        F.concat_ws("-", "l_linenumber", "l_partkey", "l_quantity").alias("numeroEmenda"),
        F.lit(None).cast("string").alias("localidadeDoGasto"),
        F.nullif("l_returnflag", F.lit("R")).alias("funcao"),
        F.lit(None).cast("string").alias("subfuncao"),
        price.alias("valorEmpenhado"),
        price.alias("valorLiquidado"),
        (price * (F.col("l_discount") * 20).cast("decimal(4,2)")).cast(S.MONEY).alias("valorPago"),
        *[F.lit(None).cast(S.MONEY).alias(c) for c in S.MONEY_COLUMNS[3:]],
    )


@query
def quarantine(spark, folder):
    staged = cleaning.staging_rows(layers(spark, folder).records, RULES)
    return mart.published(cleaning.quarantine(staged, RULES))


@query
def staging(spark, folder):
    return mart.published(cleaning.staging_rows(layers(spark, folder).records, RULES))


@query
def trusted_zero(spark, folder):
    return mart.published(layers(spark, folder).trusted)


@query
def trusted_null(spark, folder):
    staged = cleaning.staging_rows(layers(spark, folder).records, RULES)
    return mart.published(cleaning.trusted_null(staged, POSITION[1:], RULES))


@query
def trusted_null_lines(spark, folder):
    staged = cleaning.staging_rows(_line_records(spark, folder), RULES)
    return mart.published(cleaning.trusted_null(staged, ["numeroEmenda", "valorEmpenhado"], RULES)).select(
        "codigoEmenda", "ano", "autor", "numeroEmenda", "funcao", "subfuncao", "localidadeDoGasto", "uf", "valorPago"
    )


# ---- windows and relational operators ------------------------------------------------

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_REST = [
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]


@query
def dedupe_latest(spark, folder):
    return dedupe.keep_latest(table(spark, folder, "lineitem"), LINE_KEY, "l_shipdate", LINE_REST)


@query
def dedupe_first(spark, folder):
    return dedupe.keep_first(table(spark, folder, "lineitem"), LINE_KEY, ["l_shipdate", *LINE_REST])


@query
def modal_attribute(spark, folder):
    """Most frequent priority of each customer, numbered by customer."""
    modal = dedupe.modal_value(table(spark, folder, "orders"), "o_custkey", "o_orderpriority", counted="pedidos")
    return ordered.number_rows(modal, [F.asc("o_custkey")], "id").df


@query
def surrogate_key(spark, folder):
    """Dense numbers over the whole line table."""
    lines = table(spark, folder, "lineitem").select("l_shipdate", *LINE_KEY, *LINE_REST)
    order = [F.asc(c) for c in ("l_shipdate", *LINE_KEY, *LINE_REST)]
    return ordered.number_rows(lines, order, "id").df.select("id", *LINE_KEY, "l_shipdate", "l_partkey")


@query
def global_rank(spark, folder):
    """Rank and running total over all lines; the few distinct quantities make long ties."""
    key = [*LINE_KEY, "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    lines = table(spark, folder, "lineitem").select(*key, F.col("l_quantity").cast(S.MONEY).alias("quantidade"))
    return mart.published(ordered.rank_and_running_total(lines, "quantidade", key, "posicao", "acumulado"))


@query
def rank_with_nulls(spark, folder):
    """The same where the lines of one flag have no quantity: they tie at the end."""
    key = [*LINE_KEY, "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    quantity = F.when(F.col("l_returnflag") != "R", F.col("l_quantity").cast(S.MONEY))
    lines = table(spark, folder, "lineitem").select(*key, quantity.alias("quantidade"))
    return mart.published(ordered.rank_and_running_total(lines, "quantidade", key, "posicao", "acumulado"))


@query
def projection_filter(spark, folder):
    """Projection, replacement, exclusion and the filters, chained."""
    orders = table(spark, folder, "orders")
    return (
        orders.withColumnRenamed("o_totalprice", "total")
        .withColumns({"o_orderpriority": F.upper(F.trim("o_orderpriority")), "dobro": F.col("total") * 2})
        .drop("o_orderdate")
        .where(F.col("o_custkey").isNotNull())
        .where((F.col("total") > 1000) & (F.col("total") < 400000) & (F.col("o_orderstatus") != "P"))
        .where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "5-LOW"))
    )


@query
def group_aggregates(spark, folder):
    price = F.col("l_extendedprice")
    return (
        table(spark, folder, "lineitem")
        .where(F.col("l_returnflag").isNotNull())
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.count(F.lit(1)).alias("linhas"),
            money.exact_sum(price).alias("soma"),
            money.exact_mean(price).alias("media"),
            F.count_if(F.col("l_discount") > 0.05).alias("com_desconto"),
            F.round(F.count_if(F.col("l_discount") > 0.05) / F.count(F.lit(1)) * 100, 1).alias("pct_desconto"),
            F.count_distinct("l_suppkey").alias("fornecedores"),
            F.count("l_partkey").alias("pecas"),
            F.round(F.stddev_samp(price), 6).alias("desvio"),
        )
    )


@query
def distinct_options(spark, folder):
    df = layers(spark, folder).serving
    parts = [
        serving.options(df, c).select(F.lit(c).alias("filtro"), F.col(c).cast("string").alias("valor"))
        for c in ("ano", "funcao", "uf")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def global_stats(spark, folder):
    """z-score of each order total against the mean and deviation of all."""
    orders = table(spark, folder, "orders").withColumn("valorEmpenhado", F.col("o_totalprice").cast(S.MONEY))
    moments = features.committed_moments(orders)
    total = F.col("valorEmpenhado").cast("double")
    return orders.withColumn("_m", moments).select(
        "o_orderkey",
        F.round(money.ratio(total - F.col("_m.mean"), F.col("_m.sd")), 3).alias("zscore"),
        F.round(F.col("_m.mean"), 6).alias("media"),
        F.round(F.col("_m.sd"), 6).alias("desvio"),
    )


@query
def group_join_back(spark, folder):
    """Each order against its customer's own total and mean."""
    orders = table(spark, folder, "orders")
    price = F.col("o_totalprice")
    stats = stage(
        orders.groupBy("o_custkey").agg(
            money.exact_sum(price).alias("total"), money.exact_mean(price).alias("media"), F.count(F.lit(1)).alias("n")
        ),
        "customer_stats",
    )
    return joins.lookup_join(orders, stats, ["o_custkey"], "inner").select(
        "o_orderkey",
        "o_custkey",
        "n",
        F.round(money.ratio(price, F.col("total")) * 100, 2).alias("pct"),
        (price - F.col("media")).alias("desvio"),
    )


@query
def skewed_join(spark, folder):
    """Lines joined with suppliers by the salted join, every key treated as hot."""
    lines = table(spark, folder, "lineitem").select(*LINE_KEY, "l_partkey", "l_suppkey", "l_extendedprice")
    suppliers = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", "s_nationkey")
    return joins.salted_join(lines, suppliers, ["l_suppkey"], "left", rows_per_task=50)


# ---- mart ----------------------------------------------------------------------------


@query
def dim_time(spark, folder):
    return layers(spark, folder).star.dim_tempo


@query
def dim_function(spark, folder):
    return layers(spark, folder).star.dim_funcao.df


@query
def dim_place(spark, folder):
    return layers(spark, folder).star.dim_localidade.df


@query
def dim_author(spark, folder):
    return layers(spark, folder).star.dim_autor.df


@query
def fact(spark, folder):
    return mart.published(layers(spark, folder).star.fato_emendas)


@query
def rank_authors(spark, folder):
    return mart.ranking_by_author(layers(spark, folder).serving, RULES)


@query
def dist_function_region(spark, folder):
    return mart.distribution_by_function_and_region(layers(spark, folder).serving, RULES)


@query
def exec_function_place(spark, folder):
    return mart.budget_execution(layers(spark, folder).serving, RULES)


@query
def fact_joins(spark, folder):
    """Inner and left joins of the star through registered views."""
    mart.register(layers(spark, folder).star.tables())
    return spark.sql(
        """
        SELECT fe.codigoEmenda, fe.valorEmpenhado, df.area_tematica, dl.regiao, dl.localidade,
               da.tipo_simplificado, dt.periodo
        FROM fato_emendas fe
        JOIN dim_autor da ON fe.autor_id = da.autor_id
        JOIN dim_funcao df ON fe.funcao = df.funcao
        LEFT JOIN dim_localidade dl ON fe.localidade_id = dl.localidade_id
        LEFT JOIN dim_tempo dt ON fe.ano_id = dt.ano_id
        """
    )


@query
def star_denormalised(spark, folder):
    wide = serving.denormalised(layers(spark, folder).star)
    return mart.published(wide)


# ---- features ------------------------------------------------------------------------


def feature_table(spark, folder):
    return features.features(layers(spark, folder).serving, RULES)


query(feature_table, "features")


@query
def label_correlation(spark, folder):
    return features.feature_ranking(layers(spark, folder).features, 6)


@query
def correlation_matrix(spark, folder):
    return features.feature_matrix(layers(spark, folder).features, 6)


@query
def line_correlation(spark, folder):
    """Correlations over all lines, one of the columns constant and so undefined."""
    lines = table(spark, folder, "lineitem").select(
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        F.lit(1).alias("constante"),
        (F.col("l_returnflag") == "R").cast("int").alias("devolvida"),
    )
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "constante"]
    return statistics.label_correlation(lines, names, "devolvida", 6)


# ---- serving -------------------------------------------------------------------------


@query
def kpis(spark, folder):
    return serving.kpis(layers(spark, folder).cube)


@query
def coverage(spark, folder):
    return serving.coverage(layers(spark, folder).cube)


@query
def functions_totals(spark, folder):
    return serving.by_function(layers(spark, folder).cube)


@query
def top_functions(spark, folder):
    return serving.top_functions(layers(spark, folder).cube)


@query
def top_authors(spark, folder):
    return serving.top_authors(layers(spark, folder).cube)


@query
def uf_totals(spark, folder):
    return serving.by_state(layers(spark, folder).cube)


@query
def top_states(spark, folder):
    return serving.top_states(layers(spark, folder).cube)


@query
def uf_share(spark, folder):
    return serving.state_shares(layers(spark, folder).cube)


@query
def showcase_table(spark, folder):
    return serving.showcase_table(layers(spark, folder).serving)


@query
def showcase_display(spark, folder):
    """The showcase table under its display names."""
    return serving.showcase_display(layers(spark, folder).serving)


@query
def top_showcases(spark, folder):
    return serving.top_showcases(layers(spark, folder).serving)


@query
def showcase_totals(spark, folder):
    return serving.showcase_totals(layers(spark, folder).cube)


@query
def rate_histogram(spark, folder):
    return serving.rate_histogram(layers(spark, folder).serving)


@query
def scatter_set(spark, folder):
    return serving.scatter(layers(spark, folder).serving)


@query
def executive_summary(spark, folder):
    return serving.executive_summary(layers(spark, folder).cube)


@query
def report_states(spark, folder):
    return serving.report_states(layers(spark, folder).cube)


@query
def report_showcases(spark, folder):
    return serving.report_showcases(layers(spark, folder).serving)


@query
def report_authors(spark, folder):
    return serving.report_authors(layers(spark, folder).cube)


@query
def filtered_working_set(spark, folder):
    """Counts under several filter settings, among them the empty lists."""
    wide = layers(spark, folder).serving.withColumn("tipo_simplificado", RULES.type_of(F.col("tipoEmenda")))
    functions = ["1-Urgent", "5-Low"]
    settings = {
        "tudo": dict(years=RULES.years, functions=functions),
        "um_estado": dict(years=[1997, 1998], functions=functions, state="N01"),
        "um_tipo": dict(years=RULES.years, functions=functions, types=["Individual", "Outro"]),
        "tipo_vazio": dict(years=[1999], functions=functions, types=[]),
        "ano_vazio": dict(years=[], functions=functions),
        "funcao_vazia": dict(years=RULES.years, functions=[]),
    }
    out = None
    for name, chosen in settings.items():
        one = serving.filtered(wide, **chosen).agg(
            F.count(F.lit(1)).alias("linhas"),
            F.coalesce(money.exact_sum(F.col("valorEmpenhado")), F.lit(0.0)).alias("empenhado"),
        ).select(F.lit(name).alias("filtro"), "*")
        out = one if out is None else out.unionByName(one)
    return out
