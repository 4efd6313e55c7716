"""The survey marts re-expressed on the driver's TPC-H-like tables.

Analogy: respondent = order (or document, or user), edition/year =
``year(o_orderdate)`` (or language, or day), categorical answers = status,
priority, segment, region; a multi-select cell = comma-separated document text
or the set of an order's part types. Every query reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakemart.functions.text import slug
from lakemart.operators import (Dimension, add_lineage, compare_contents, count_mart, count_marts,
                                dictionary_coverage, mart_names,
                                discover_vocabulary, distinct_mart,
                                duplicate_keys, explode_discovered, explode_options,
                                long_format, null_overall, null_profile,
                                recode_boolean, recode_values, sanitize_columns,
                                select_by_dictionary, share_mart, top_k, typed_columns,
                                union_editions, unmapped_report, value_counts,
                                with_discovered_tokens,
                                write_and_reconcile, write_and_verify)
from lakemart.operators.names import column_map_frame
from lakemart.operators.distinct_state import DistinctStore, state_counts, state_shares
from lakemart.operators.frequent import frequent_values
from lakemart.operators.marts import mart_order, order_mart, parts_for
from lakemart.operators.quality import duplicate_key_count, invalid_rows, rows_per_group
from lakemart.operators.unify import check_dictionary, mapping_for
from lakemart.session import delete_path, ensure_semantics, materialize, scratch_path
from lakemart.sinks.catalog import register_layer, register_marts, run_sql
from lakemart.sinks.files import export_csv, write_column_map, write_edition, write_partitioned
from lakemart.sinks.publish import PublishError, publish, register_published
from lakemart.sources.csv import read_editions, read_raw_csv, read_split_csv
from lakemart.sources.dictionary import dictionary_from_rows, read_dictionary
from lakemart.sources.footers import stored_null_profile
from lakemart.sources.parquet import read_leaf

# Fixed values of the analogues (shared with the SQL oracles).
TYPE_OPTION_SUFFIX = " (novo, usado)."   # part types become comma-bearing options
BOOLEAN_MAP = {"1": "Sim", "TRUE": "Sim", "0": "Não", "FALSE": "Não"}
PRIORITY_RECODE = {"4-NOT SPECIFIED": "5-LOW"}
EARLY_ERA_LAST_YEAR = 1997               # orders editions: <= 1997 and later
#: Stands for NULL while reading CSV, so that the empty string is kept apart.
NO_VALUE = "\ue000"
TS_PATTERN = "dd/MM/yyyy HH:mm:ss"
FIXED_INGESTION = "2024-01-01T00:00:00+00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _year(col: str = "o_orderdate"):
    return F.year(col).cast("int")


def _orders_customers(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
        _year().alias("year"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")


def _with_geography(spark, sf_dir, df: DataFrame) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (df.join(nation, df.c_nationkey == nation.n_nationkey, "inner")
              .join(region, nation.n_regionkey == region.r_regionkey, "inner"))


# ---- count marts (MART-2/3/4/7) -------------------------------------------

def market_panorama(spark, sf_dir):
    ensure_semantics(spark)
    return count_mart(_orders_customers(spark, sf_dir),
                      ["year", "o_orderstatus", "c_mktsegment", "o_orderpriority"], "n_orders")


def professional_profiles(spark, sf_dir):
    ensure_semantics(spark)
    return count_mart(_orders_customers(spark, sf_dir),
                      ["year", "c_mktsegment", "o_orderpriority"], "n_orders")


def _geography_mart(spark, sf_dir, keys: list[str], facts: list[str]) -> DataFrame:
    """Counted by nation key first; the names meet the counts, not the orders."""
    counted = count_mart(_orders_customers(spark, sf_dir), [*facts, "c_nationkey"], "n", sort=False)
    named = _with_geography(spark, sf_dir, counted)
    return order_mart(named.groupBy(*keys).agg(F.sum("n").alias("n_orders")), keys, "n_orders")


def diversity_profile(spark, sf_dir):
    ensure_semantics(spark)
    facts = ["year", "c_mktsegment", "o_orderpriority", "o_orderstatus"]
    return _geography_mart(spark, sf_dir, [*facts, "n_name", "r_name"], facts)


def regional_profile(spark, sf_dir):
    ensure_semantics(spark)
    return _geography_mart(spark, sf_dir, ["year", "r_name", "o_orderpriority", "o_orderstatus"],
                           ["year", "o_orderpriority", "o_orderstatus"])


# ---- share marts (MART-5, AGG-2/3/4) --------------------------------------

def technology_adoption(spark, sf_dir):
    """Options of the comma-separated text per language: distinct documents
    and their share of all documents of that language."""
    ensure_semantics(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    exploded = explode_options(docs, "text", "option", distinct=True)
    return share_mart(exploded, docs, "lang", ["option"], "doc_id", "n_docs", "pct_docs")


def order_flag_adoption(spark, sf_dir):
    """Technology-mart shape: several simple multi-select categories per
    respondent (an order's return flags and line statuses, joined by ", "),
    stacked in one scan, with the share of all orders of the year."""
    ensure_semantics(spark)
    # the distinct pairs of an order and the flags of its lines first: no set per
    # order is gathered, and the long format then works on fewer rows. Dealt once, by
    # order: the distinct rows, the join and the distinct orders come from that
    lines, parts = _order_lines(spark, sf_dir, "l_returnflag", "l_linestatus")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", _year().alias("year")) \
        .repartition(parts, "o_orderkey")
    base = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "inner")
    long = long_format(base, ["year", "o_orderkey"], [
        Dimension("Return flag", "l_returnflag", multiselect=True),
        Dimension("Line status", "l_linestatus", multiselect=True),
    ], dimension_col="categoria", value_col="tecnologia", distinct=True)
    # orders without lines only count in the denominator, which orders alone give
    return share_mart(long, orders, "year", ["categoria", "tecnologia"], "o_orderkey",
                      "n_orders", "pct_orders")


def _order_lines(spark, sf_dir, *columns: str) -> tuple[DataFrame, int]:
    """The distinct rows (l_orderkey, *columns) of the order lines, dealt by order,
    and into how many parts: as many as the lines need, so that a task's distinct
    rows do not grow with the table."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *columns)
    parts = parts_for(lines)
    return lines.repartition(parts, "l_orderkey").distinct(), parts


def _events_by_day(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("day"), "event_type", "user_id")


def daily_event_reach(spark, sf_dir):
    ensure_semantics(spark)
    events = _events_by_day(spark, sf_dir)
    return share_mart(events, events, "day", ["event_type"], "user_id", "n_users", "pct_users")


def distinct_denominator(spark, sf_dir):
    ensure_semantics(spark)
    return distinct_mart(_events_by_day(spark, sf_dir), ["day"], "user_id", "n_users",
                         sort=False)


def purchase_reach(spark, sf_dir):
    """A mart filtered to one category (the filter reaches the scan)."""
    ensure_semantics(spark)
    return daily_event_reach(spark, sf_dir).where(F.col("event_type") == "purchase")


# ---- vocabulary multi-select (MS-2/3/4, MART-6) ----------------------------

def _order_type_cells(spark, sf_dir) -> DataFrame:
    """One cell per order: its distinct part types as comma-bearing options,
    sorted and joined by ", ". Dealt once, by order: the distinct pairs and the
    cells then come from that one shuffle."""
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    parts = parts_for(lineitem)
    options = F.transform(F.collect_list("p_type"),
                          lambda t: F.concat(t, F.lit(TYPE_OPTION_SUFFIX)))
    return (lineitem.join(part, lineitem.l_partkey == part.p_partkey, "inner")
                    .select("l_orderkey", "p_type").repartition(parts, "l_orderkey").distinct()
                    .groupBy("l_orderkey")
                    .agg(F.array_join(F.array_sort(options), ", ").alias("cell")))


def vocabulary_discovery(spark, sf_dir):
    ensure_semantics(spark)
    return discover_vocabulary(_order_type_cells(spark, sf_dir), "cell")


def part_type_adoption(spark, sf_dir):
    ensure_semantics(spark)
    cells = materialize(_order_type_cells(spark, sf_dir), "order-cells")
    cells = with_discovered_tokens(cells, "cell", "options").select("l_orderkey", "options") \
        .repartition(parts_for(table(spark, sf_dir, "lineitem")), "l_orderkey")
    exploded = cells.select("l_orderkey", F.explode("options").alias("option"))
    return distinct_mart(exploded, ["option"], "l_orderkey", "n_orders", sort=False)


def order_adoption_long(spark, sf_dir):
    """Three signals per order in one long mart: its part types (vocabulary
    multi-select), its status and its customer's nation."""
    ensure_semantics(spark)
    cells = materialize(_order_type_cells(spark, sf_dir), "order-cells")
    # dealt by order, for the join and the distinct orders of every value
    parts = parts_for(table(spark, sf_dir, "lineitem"))
    cells = with_discovered_tokens(cells, "cell", "types").select("l_orderkey", "types") \
        .repartition(parts, "l_orderkey")
    orders = _orders_customers(spark, sf_dir)
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    orders = orders.join(nation, orders.c_nationkey == nation.n_nationkey, "inner") \
        .repartition(parts, "o_orderkey")
    base = orders.join(cells, orders.o_orderkey == cells.l_orderkey, "left")
    long = long_format(base, ["year", "o_orderkey", "c_mktsegment", "o_orderpriority"], [
        Dimension("part_types", "types", tokens=True),
        Dimension("order_status", "o_orderstatus"),
        Dimension("customer_nation", "n_name"),
    ], dimension_col="dimension", value_col="valor")
    return distinct_mart(long, ["year", "dimension", "c_mktsegment", "o_orderpriority", "valor"],
                         "o_orderkey", "n_orders", leading=2)


# ---- long format (MART-8) -------------------------------------------------

def document_maturity_long(spark, sf_dir):
    ensure_semantics(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    long = long_format(docs, ["lang", "doc_id"], [
        Dimension("source", "source"),
        Dimension("text_option", "text", multiselect=True),
    ], dimension_col="dimension", value_col="valor", distinct=True)
    return distinct_mart(long, ["lang", "dimension", "valor"], "doc_id", "n_docs", leading=2)


def order_status_priority_long(spark, sf_dir):
    ensure_semantics(spark)
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", _year().alias("year"), "o_orderstatus", "o_orderpriority")
    long = long_format(orders, ["year", "o_orderkey"], [
        Dimension("status", "o_orderstatus"), Dimension("priority", "o_orderpriority"),
    ], dimension_col="dimension", value_col="valor")
    return distinct_mart(long, ["year", "dimension", "valor"], "o_orderkey", "n_orders", leading=2)


# ---- marts from mergeable distinct counts (MART-5/6/8) ---------------------

def distinct_rollups(spark, sf_dir):
    """Marts of distinct customers from one state of bitmaps per finest key, to
    which the later orders are added as a second batch: shares of line flags per
    year (MART-5), statuses per segment and priority (MART-6), priorities per
    segment (MART-8), and all values over all years."""
    ensure_semantics(spark)
    orders = _orders_customers(spark, sf_dir)
    lines, _ = _order_lines(spark, sf_dir, "l_returnflag")
    flags = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_returnflag")).alias("flags"))
    base = orders.join(flags, orders.o_orderkey == flags.l_orderkey, "left")
    keys = ["year", "dimension", "c_mktsegment", "o_orderpriority", "valor"]
    long = long_format(base.withColumn("everyone", F.lit("")),
                       ["year", "o_custkey", "c_mktsegment", "o_orderpriority"], [
        Dimension("return_flag", "flags", tokens=True), Dimension("order_status", "o_orderstatus"),
        Dimension("priority", "o_orderpriority"), Dimension("everyone", "everyone"),
    ], dimension_col="dimension", value_col="valor")
    store = DistinctStore(spark, scratch_path(spark, "distinct-state"))
    early = F.coalesce(F.col("year") <= EARLY_ERA_LAST_YEAR, F.lit(False))
    store.add("early", long.where(early), keys, "o_custkey")
    store.add("late", long.where(~early), keys, "o_custkey")
    state = store.state()

    def of(dimension):
        return state.where(F.col("dimension") == dimension)

    marts = {
        "technology": state_shares(of("return_flag"), of("everyone"), "year", ["dimension", "valor"],
                                   "n_customers", "pct_customers", sort=False),
        "adoption": state_counts(of("order_status"), keys, "n_customers", sort=False),
        "maturity": state_counts(of("priority"), ["year", "dimension", "c_mktsegment", "valor"],
                                 "n_customers", sort=False),
        "overall": state_counts(state, ["dimension", "valor"], "n_customers", sort=False),
    }
    out = None
    for name, mart in marts.items():
        mart = mart.withColumn("mart", F.lit(name))
        out = mart if out is None else out.unionByName(mart, allowMissingColumns=True)
    return out.select("mart", *keys, "n_customers", "pct_customers")


# ---- base projection (MART-1) ---------------------------------------------

def respondent_base(spark, sf_dir):
    ensure_semantics(spark)
    df = _with_geography(spark, sf_dir, _orders_customers(spark, sf_dir))
    return df.select("o_orderkey", "year", "o_orderstatus", "o_orderpriority",
                     "c_custkey", "c_mktsegment", "n_name", "r_name")


# ---- unification (COL-5/6, SET-1) -----------------------------------------

# Fixed dictionary of the orders "editions": field, early column, late column.
ORDERS_DICTIONARY = [
    ("order_id", "o_orderkey", "o_orderkey"),
    ("customer_id", "o_custkey", "o_custkey"),
    ("status", "o_orderstatus", None),
    ("total", "o_totalprice", "o_totalprice"),
    ("order_date", "o_orderdate", "o_orderdate"),
    ("priority", None, "o_orderpriority"),
    ("clerk", "o_clerk", None),
    ("comment", None, "o_comment"),
]
DICT_COLUMNS = ["campo_padronizado", "col_early", "col_late"]


def _order_editions(spark, sf_dir) -> dict[str, DataFrame]:
    """Two editions split at a year boundary, written as a range on the raw
    column (not ``year(...) <= y``) so the predicate reaches the Parquet scan."""
    orders = table(spark, sf_dir, "orders")
    boundary = F.lit(f"{EARLY_ERA_LAST_YEAR + 1}-01-01 00:00:00").cast(
        dict(orders.dtypes)["o_orderdate"])
    return {"early": orders.where(F.col("o_orderdate") < boundary),
            # an order without a date is in the later edition
            "late": orders.where((F.col("o_orderdate") >= boundary) | F.col("o_orderdate").isNull())}


def edition_union(spark, sf_dir):
    ensure_semantics(spark)
    editions = _order_editions(spark, sf_dir)
    dictionary = dictionary_from_rows(spark, ORDERS_DICTIONARY, DICT_COLUMNS)
    frames = []
    for number, (name, df) in enumerate(editions.items(), start=1):
        # dictionary fields without their column stay, as NULL
        mapped = select_by_dictionary(df, mapping_for(dictionary, f"col_{name}"), strict=False)
        frames.append(mapped.withColumn("edition", F.lit(number)))
    return union_editions(frames)


def dictionary_check(spark, sf_dir):
    ensure_semantics(spark)
    editions = _order_editions(spark, sf_dir)
    dictionary = dictionary_from_rows(spark, ORDERS_DICTIONARY, DICT_COLUMNS)
    return dictionary_coverage(spark, dictionary, editions,
                               {"early": "col_early", "late": "col_late"})


# ---- standardisation (FN-1/2/3/4, STD-1..5) --------------------------------

def _documents_labels(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    return docs.join(labels, on="doc_id", how="left")


def boolean_recode_counts(spark, sf_dir):
    ensure_semantics(spark)
    df = _documents_labels(spark, sf_dir).select("doc_id", "quality", "toxic")
    recoded = recode_boolean(df, ["quality", "toxic"], BOOLEAN_MAP)
    return count_mart(recoded, ["quality", "toxic"], "n_docs", sort=False)


def value_recode_counts(spark, sf_dir):
    ensure_semantics(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority")
    recoded = recode_values(orders, {"o_orderpriority": PRIORITY_RECODE})
    return count_mart(recoded, ["o_orderstatus", "o_orderpriority"], "n_orders", sort=False)


def typed_parse(spark, sf_dir):
    """Text answers parsed to timestamp and int; bad text becomes NULL."""
    ensure_semantics(spark)
    events = table(spark, sf_dir, "events")
    is_error = F.col("event_type") == "error"
    text = events.select(
        "event_id",
        F.when(is_error, F.date_format("ts", "yyyy-MM-dd"))
         .otherwise(F.date_format("ts", TS_PATTERN)).alias("sent_at"),
        F.when(is_error, F.col("event_type"))
         .otherwise(F.regexp_extract("props", r":\s*(-?\d+)", 1)).alias("k_value"))
    return typed_columns(text, timestamps={"sent_at": TS_PATTERN}, integers=["k_value"])


# ---- quality (QC-1..7, AGG-5..10) -----------------------------------------

def null_profile_report(spark, sf_dir):
    ensure_semantics(spark)
    return null_profile(_documents_labels(spark, sf_dir))


def stored_null_report(spark, sf_dir):
    """Null profiles from the files' footers: of documents' attributes with their
    labels, written in folders by language, and of tables as they are stored
    (the texts among them)."""
    ensure_semantics(spark)
    path = scratch_path(spark, "documents-labels")
    write_partitioned(_documents_labels(spark, sf_dir).drop("text"), path, "lang")
    stored = {"documents_labels": path, **{n: f"{sf_dir.rstrip('/')}/{n}.parquet"
                                           for n in ("documents", "orders", "lineitem", "embeddings")}}
    reports = [stored_null_profile(spark, place).select(F.lit(name).alias("table_name"), "*")
               for name, place in stored.items()]
    delete_path(spark, path)
    return reduce(DataFrame.unionByName, reports)


def null_overall_report(spark, sf_dir):
    ensure_semantics(spark)
    return null_overall(_documents_labels(spark, sf_dir))


def duplicate_line_keys(spark, sf_dir):
    ensure_semantics(spark)
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return duplicate_keys(lineitem, ["l_orderkey", "l_linenumber"])


def duplicate_line_key_count(spark, sf_dir):
    ensure_semantics(spark)
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return duplicate_key_count(lineitem, ["l_orderkey", "l_linenumber"])


def orders_per_year(spark, sf_dir):
    ensure_semantics(spark)
    orders = table(spark, sf_dir, "orders").select(_year().alias("year"))
    return rows_per_group(orders, "year", "n_orders")


# Fixed lookup used to show which answers a map recode would null out.
STATUS_AS_BOOLEAN = {"F": "Sim", "O": "Não"}


def unmapped_recode_values(spark, sf_dir):
    ensure_semantics(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority")
    return unmapped_report(orders, ["o_orderstatus", "o_orderpriority"], STATUS_AS_BOOLEAN)


def top_null_columns(spark, sf_dir):
    """The 15 columns with most NULLs of a wide left-joined table, ties by position."""
    ensure_semantics(spark)
    customer, orders, lineitem = (table(spark, sf_dir, t) for t in ("customer", "orders", "lineitem"))
    # customers without orders have no answer in the 17 columns of the other two
    wide = (customer.join(orders, customer.c_custkey == orders.o_custkey, "left")
                    .join(lineitem, orders.o_orderkey == lineitem.l_orderkey, "left"))
    return top_k(null_profile(wide), 15, [F.col("n_nulls").desc(), F.col("position").asc()])


def value_frequencies(spark, sf_dir):
    ensure_semantics(spark)
    events = value_counts(table(spark, sf_dir, "events"), ["event_type"], sort=False)
    orders = value_counts(table(spark, sf_dir, "orders"),
                          ["o_orderstatus", "o_orderpriority"], sort=False)
    return events.unionByName(orders)


def frequent_values_report(spark, sf_dir):
    """Top 15 values of all columns of orders with their customers, exact, with
    ties to the smaller value: coded answers, dates, names and ids."""
    ensure_semantics(spark)
    customer = table(spark, sf_dir, "customer").drop("c_acctbal")
    orders = table(spark, sf_dir, "orders").drop("o_totalprice")
    wide = orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd")) \
        .join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    return frequent_values(materialize(wide, "wide"), k=15).withColumn("rank", F.col("rank").cast("long"))


def top_sources(spark, sf_dir):
    """Top-15 document sources by frequency (ties broken by name)."""
    ensure_semantics(spark)
    counts = value_counts(table(spark, sf_dir, "documents"), ["source"], sort=False)
    return top_k(counts, 15, [F.col("n_rows").desc(), F.col("value").asc()]) \
        .select("value", "n_rows")


COUNT_MART_KEYS = {
    "market_panorama": ["year", "o_orderstatus", "c_mktsegment", "o_orderpriority"],
    "professional_profiles": ["year", "c_mktsegment", "o_orderpriority"],
    "diversity_profile": ["year", "c_mktsegment", "o_orderpriority", "o_orderstatus",
                          "n_name", "r_name"],
    "regional_profile": ["year", "r_name", "o_orderpriority", "o_orderstatus"],
}


def invalid_mart_rows(spark, sf_dir):
    """Rows with a non-positive count in each of the four count marts, computed
    from one scan and join of the source (all marts as grouping sets)."""
    ensure_semantics(spark)
    base = _with_geography(spark, sf_dir, _orders_customers(spark, sf_dir))
    combined = count_marts(base, COUNT_MART_KEYS, "n_orders")
    return (combined.withColumn("mart", F.explode(mart_names(combined, COUNT_MART_KEYS)))
                    .groupBy("mart")
                    .agg(F.count(F.when(F.col("n_orders") <= 0, 1)).alias("invalid_rows"),
                         F.count(F.lit(1)).alias("mart_rows")))


def reconcile_tables(spark, sf_dir):
    ensure_semantics(spark)
    tables = {n: table(spark, sf_dir, n) for n in ("customer", "orders", "lineitem")}
    return write_and_reconcile(spark, tables, scratch_path(spark, "reconcile"), cleanup=True)


def content_report(spark, sf_dir):
    """Three tables written, read back and compared by content; and orders
    against copies that went wrong without a change of the row count: one
    price changed, the customers of two orders exchanged, a row lost and one doubled."""
    ensure_semantics(spark)
    orders = table(spark, sf_dir, "orders")
    first, last = (F.col("o_orderkey") == F.lit(k) for k in orders.agg(
        F.min("o_orderkey"), F.max("o_orderkey")).first())
    customers = orders.where(first | last).agg(F.max(F.when(first, F.col("o_custkey"))).alias("of_first"),
                                               F.max(F.when(last, F.col("o_custkey"))).alias("of_last")).first()
    wrong = {
        "orders, a cell changed": orders.withColumn("o_totalprice", F.when(
            first, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))),
        "orders, two cells exchanged": orders.withColumn("o_custkey", F.when(first, F.lit(customers.of_last))
            .when(last, F.lit(customers.of_first)).otherwise(F.col("o_custkey"))),
        "orders, a row doubled": orders.where(~last).unionByName(orders.where(first)),
    }
    written = write_and_verify(spark, {n: table(spark, sf_dir, n) for n in ("customer", "orders", "lineitem")},
                               scratch_path(spark, "verify"), cleanup=True)
    return written.unionByName(compare_contents(spark, {n: (orders, w) for n, w in wrong.items()})
                               .where(F.col("status") != "OK"))


# ---- names and lineage (COL-1/2/3/4/7) ------------------------------------

def text_slug(spark, sf_dir):
    ensure_semantics(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", slug(F.col("text"), max_len=None).alias("slug"))


# Fixed awkward headers given to the customer columns (two collide on purpose).
AWKWARD_HEADERS = ["Cliente ID", "Nome do Cliente", "Nação (código)", "Saldo R$",
                   "Segmento de Mercado", "nome do cliente!"]


def column_map(spark, sf_dir):
    """Raw -> sanitised header map of a table with awkward headers, with the
    number of values each column holds."""
    ensure_semantics(spark)
    customer = table(spark, sf_dir, "customer")
    raw = customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
                          F.col("c_name").alias("c_name_2")).toDF(*AWKWARD_HEADERS)
    clean, mapping = sanitize_columns(raw)
    counts = clean.agg(*[F.count(F.col(c)).alias(c) for c in clean.columns])
    per_col = counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("coluna_saneada"), F.col(c).alias("n_values")) for c in clean.columns])))
    return column_map_frame(spark, mapping).join(per_col, on="coluna_saneada", how="inner") \
        .select("position", "coluna_bruta", "coluna_saneada", "n_values")


def lineage_columns(spark, sf_dir):
    ensure_semantics(spark)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    stamped = add_lineage(orders, _year(), ingested_at=FIXED_INGESTION)
    return stamped.drop("o_orderdate")


# ---- round trips (SRC-1/2/3, SNK-1/2/5, QC-1) ------------------------------

def bronze_round_trip(spark, sf_dir):
    """Write orders partitioned by edition (year), read the layer back and
    reconcile rows per edition."""
    ensure_semantics(spark)
    orders = table(spark, sf_dir, "orders").withColumn("ano", _year())
    path = scratch_path(spark, "bronze")
    write_partitioned(orders, path, "ano")
    back = spark.read.parquet(path)
    written = orders.groupBy("ano").agg(F.count(F.lit(1)).alias("rows_written"))
    read = back.groupBy("ano").agg(F.count(F.lit(1)).alias("rows_read"))
    read = materialize(read, "read-back")
    delete_path(spark, path)                           # counted: the copy goes
    return (written.join(read.withColumnRenamed("ano", "back"), F.col("ano").eqNullSafe(F.col("back")), "full")
                   .withColumn("ano", F.coalesce("ano", "back"))
                   .withColumn("status", F.when(F.col("rows_written") == F.col("rows_read"), "OK")
                                          .otherwise("DIVERGENTE"))
                   .select(F.col("ano").cast("int").alias("ano"), "rows_written",
                           "rows_read", "status"))


def csv_round_trip(spark, sf_dir):
    """Export documents in the quoted CSV format and scan them back with the
    raw-CSV reader (quotes and newlines inside fields survive)."""
    ensure_semantics(spark)
    path = scratch_path(spark, "csv")
    export_csv(table(spark, sf_dir, "documents"), path)
    back = materialize(read_raw_csv(spark, path, nullValue=NO_VALUE).select(
        F.col("doc_id").try_cast("bigint").alias("doc_id"), "text", "lang", "source",
        F.col("n_chars").try_cast("bigint").alias("n_chars")), "csv-back")
    delete_path(spark, path)
    return back


def csv_split_round_trip(spark, sf_dir):
    """Export documents in the quoted CSV format and read them back by byte
    ranges: line breaks and quotes inside fields, several tasks a file."""
    ensure_semantics(spark)
    path = scratch_path(spark, "csv-split")
    export_csv(table(spark, sf_dir, "documents"), path)
    back = materialize(read_split_csv(spark, path, nullValue=NO_VALUE).select(
        F.col("doc_id").try_cast("bigint").alias("doc_id"), "text", "lang", "source",
        F.col("n_chars").try_cast("bigint").alias("n_chars")), "csv-split-back")
    delete_path(spark, path)
    return back


def mart_file_round_trip(spark, sf_dir):
    """A mart exported as one ordered file and read back, with each row's place
    in the file."""
    ensure_semantics(spark)
    path = scratch_path(spark, "mart-csv")
    keys = ["year", "c_mktsegment", "o_orderpriority"]
    export_csv(count_mart(_orders_customers(spark, sf_dir), keys, "n_orders", sort=False), path,
               single_file=True, order_by=mart_order(keys, "n_orders"))
    # one file, one task: the running number of its rows is their place
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("place"), "value") \
        .where("place > 0")
    cells = F.split("value", ",")
    return materialize(lines.select("place", *[
        F.regexp_replace(cells[i], '^"|"$', "").alias(c) for i, c in enumerate([*keys, "n_orders"])])
        .select("place", F.col("year").cast("int").alias("year"), "c_mktsegment", "o_orderpriority",
                F.col("n_orders").cast("long").alias("n_orders")), "mart-back")


def mart_parts_round_trip(spark, sf_dir):
    """A mart in the two-key order (edition and segment, then the count
    descending) exported by all tasks as the parts of one file, and read back
    with each row's place in the joined parts: the rows of the parts before, a
    row a part, and its place in its own."""
    ensure_semantics(spark)
    path = scratch_path(spark, "mart-parts")
    keys = ["year", "c_mktsegment", "o_orderpriority"]
    export_csv(count_mart(_orders_customers(spark, sf_dir), keys, "n_orders", sort=False), path,
               order_by=mart_order(keys, "n_orders", leading=2), one_header=True)
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_name").alias("part"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("nth"))
    placed = materialize(lines.withColumn("own", F.row_number().over(
        Window.partitionBy("part").orderBy("block", "nth"))), "placed")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    cells = F.split("value", ",")
    # the header is line 0
    out = placed.join(parts, "part").withColumn("place", (F.col("before") + F.col("own") - 1).cast("long")) \
        .where("place > 0").select("place", *[
            F.regexp_replace(cells[i], '^"|"$', "").alias(c) for i, c in enumerate([*keys, "n_orders"])])
    return out.withColumns({"year": F.col("year").cast("int"), "n_orders": F.col("n_orders").cast("long")})


def edition_leaves(spark, sf_dir):
    """Each edition written to its own leaf under the dictionary's names, read
    back leaf by leaf: rows and answered priorities per edition."""
    ensure_semantics(spark)
    base = scratch_path(spark, "leaves")
    dictionary = dictionary_from_rows(spark, ORDERS_DICTIONARY, DICT_COLUMNS)
    counts = []
    for name, df in _order_editions(spark, sf_dir).items():
        write_edition(select_by_dictionary(df, mapping_for(dictionary, f"col_{name}"), strict=False),
                      base, name, "edition")
        leaf = read_leaf(spark, base, "edition", name)
        answered = F.count("priority") if "priority" in leaf.columns else F.lit(0).cast("long")
        counts.append(leaf.agg(F.count(F.lit(1)).alias("n_rows"), answered.alias("n_priority"))
                      .select(F.lit(name).alias("edition"), "n_rows", "n_priority",
                              F.lit(len(leaf.columns)).alias("n_columns")))
    return materialize(counts[0].unionByName(counts[1]), "leaf-counts")


def missing_dictionary_fields(spark, sf_dir):
    """The dictionary as a CSV file: its entries without a column in their
    edition, with the edition's row count."""
    ensure_semantics(spark)
    path = scratch_path(spark, "dictionary")
    export_csv(dictionary_from_rows(spark, ORDERS_DICTIONARY, DICT_COLUMNS), path, single_file=True)
    editions = _order_editions(spark, sf_dir)
    missing = check_dictionary(spark, read_dictionary(spark, path), editions,
                               {"early": "col_early", "late": "col_late"})
    sizes = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("edition"), "n_rows")
             for n, df in editions.items()]
    return missing.join(sizes[0].unionByName(sizes[1]), "edition")


def column_map_file(spark, sf_dir):
    """The header map written as a CSV file and read back, and the raw CSV
    editions it belongs to: rows per edition."""
    ensure_semantics(spark)
    base = scratch_path(spark, "raw")
    paths = {}
    for name, df in _order_editions(spark, sf_dir).items():
        renamed = df.select(F.col("o_orderkey").alias("Pedido (nº)"), F.col("o_orderpriority").alias("Prioridade!"))
        export_csv(renamed, f"{base}/{name}")
        paths[name] = f"{base}/{name}"
    out = []
    for name, raw in read_editions(spark, paths).items():
        clean, mapping = sanitize_columns(raw)
        write_column_map(spark, mapping, f"{base}/map-{name}")
        back = read_dictionary(spark, f"{base}/map-{name}")
        rows = clean.agg(F.count("pedido_no").alias("n_rows"))
        out.append(back.join(rows).select(F.lit(name).alias("edition"), "coluna_bruta", "coluna_saneada", "n_rows"))
    return materialize(out[0].unionByName(out[1]), "maps")


def invalid_measure_rows(spark, sf_dir):
    """Rows whose summed measure is not positive, in two marts with such rows:
    full-price lines per part and late-year orders per customer."""
    ensure_semantics(spark)
    lines = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.sum(F.when(F.col("l_discount") == 0, 1).otherwise(0)).alias("n"))
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.sum(F.when(_year() > EARLY_ERA_LAST_YEAR, 1).otherwise(0)).alias("n"))
    return invalid_rows({"full_price_lines": lines, "late_orders": orders}, "n")


def prefix_option_adoption(spark, sf_dir):
    """Vocabulary options that are prefixes of others and hold separators: an
    order's priority, alone or with its status, and trailing separators."""
    ensure_semantics(spark)
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    short = F.concat(priority, F.lit("."))
    long = F.concat(priority, F.lit(". more, "), status, F.lit("."))
    cell = F.when(F.col("o_orderkey") % 4 == 0, short).when(F.col("o_orderkey") % 4 == 1, long) \
        .when(F.col("o_orderkey") % 4 == 2, F.concat(short, F.lit(", "), long)) \
        .otherwise(F.concat(long, F.lit(", "), short, F.lit(", ")))
    cells = table(spark, sf_dir, "orders").select("o_orderkey", cell.alias("cell"))
    exploded = explode_discovered(materialize(cells, "cells"), "cell", "option")
    return distinct_mart(exploded, ["option"], "o_orderkey", "n_orders", sort=False)


# ---- ad hoc SQL over registered marts (MART-9, SNK-4) ---------------------

TOP_SEGMENT_SQL = """
SELECT year, c_mktsegment, n_orders
FROM (
  SELECT year, c_mktsegment, SUM(n_orders) AS n_orders,
         ROW_NUMBER() OVER (PARTITION BY year
                            ORDER BY SUM(n_orders) DESC, c_mktsegment) AS rk
  FROM mart_market_panorama
  GROUP BY year, c_mktsegment
) ranked
WHERE rk = 1
"""


def top_segment_sql(spark, sf_dir):
    ensure_semantics(spark)
    register_marts(spark, {"mart_market_panorama": market_panorama(spark, sf_dir)})
    return spark.sql(TOP_SEGMENT_SQL)


def layer_table(spark, sf_dir):
    """A catalog table over the early edition, then over both after the later one
    came with another column (priority) and without one (status): rows and
    answers per edition from SQL, and how many columns the table got each time."""
    ensure_semantics(spark)
    base = scratch_path(spark, "layer")
    name = "layer_" + base.rsplit("-", 1)[1]
    gone = {"early": "o_orderpriority", "late": "o_orderstatus"}
    parts = []
    for edition, df in _order_editions(spark, sf_dir).items():
        write_edition(df.drop(gone[edition]), base, edition, "edition")
        added = len(register_layer(spark, name, base, "edition"))
        priority = "count(o_orderpriority)" if edition == "late" else "0L"
        parts.append(materialize(run_sql(spark, f"""
            SELECT '{edition}' AS registered, {added} AS columns_added, edition, count(*) AS n_rows,
                   count(o_orderstatus) AS n_status, {priority} AS n_priority
            FROM {name} GROUP BY edition"""), "layer-counts"))
    run_sql(spark, f"DROP TABLE {name}")
    delete_path(spark, base)
    return parts[0].unionByName(parts[1])


PUBLISHED_SQL = """
SELECT 'mart_profiles' AS mart, year, count(*) AS n_rows, sum(n_orders) AS n_orders
FROM mart_profiles GROUP BY year
UNION ALL
SELECT 'mart_panorama', year, count(*), sum(n_orders) FROM mart_panorama GROUP BY year
"""


def published_marts(spark, sf_dir):
    """Two marts of the early orders, published together; then one of them over
    all orders; then a publication of both whose second fails its check. Readers
    see the second version: a mart of early orders, a mart of all."""
    ensure_semantics(spark)
    root = scratch_path(spark, "published")
    orders = _orders_customers(spark, sf_dir)
    early = orders.where(F.col("year") <= EARLY_ERA_LAST_YEAR)
    late = orders.where(F.col("year") > EARLY_ERA_LAST_YEAR)

    def profiles(df):
        return count_mart(df, ["year", "c_mktsegment", "o_orderpriority"], "n_orders", sort=False)

    def panorama(df):
        return count_mart(df, COUNT_MART_KEYS["market_panorama"], "n_orders", sort=False)

    publish(spark, {"mart_profiles": profiles(early), "mart_panorama": panorama(early)}, root)
    publish(spark, {"mart_profiles": profiles(orders)}, root,
            {"mart_profiles": lambda df: df.where("n_orders <= 0").isEmpty()})
    try:
        publish(spark, {"mart_profiles": profiles(late), "mart_panorama": panorama(late)}, root,
                {"mart_panorama": lambda df: not df.where(F.col("year") <= EARLY_ERA_LAST_YEAR).isEmpty()})
    except PublishError:
        register_published(spark, root)
        return spark.sql(PUBLISHED_SQL)
    raise AssertionError("a publication was accepted that fails its check")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "technology_adoption": technology_adoption,
    "market_panorama": market_panorama,
    "order_flag_adoption": order_flag_adoption,
    "professional_profiles": professional_profiles,
    "diversity_profile": diversity_profile,
    "regional_profile": regional_profile,
    "daily_event_reach": daily_event_reach,
    "part_type_adoption": part_type_adoption,
    "order_adoption_long": order_adoption_long,
    "document_maturity_long": document_maturity_long,
    "order_status_priority_long": order_status_priority_long,
    "distinct_rollups": distinct_rollups,
    "respondent_base": respondent_base,
    "edition_union": edition_union,
    "boolean_recode_counts": boolean_recode_counts,
    "value_recode_counts": value_recode_counts,
    "typed_parse": typed_parse,
    "null_profile_report": null_profile_report,
    "stored_null_report": stored_null_report,
    "null_overall_report": null_overall_report,
    "duplicate_line_keys": duplicate_line_keys,
    "reconcile_tables": reconcile_tables,
    "content_report": content_report,
    "value_frequencies": value_frequencies,
    "duplicate_line_key_count": duplicate_line_key_count,
    "orders_per_year": orders_per_year,
    "unmapped_recode_values": unmapped_recode_values,
    "frequent_values_report": frequent_values_report,
    "top_null_columns": top_null_columns,
    "invalid_mart_rows": invalid_mart_rows,
    "dictionary_check": dictionary_check,
    "text_slug": text_slug,
    "column_map": column_map,
    "lineage_columns": lineage_columns,
    "vocabulary_discovery": vocabulary_discovery,
    "top_sources": top_sources,
    "bronze_round_trip": bronze_round_trip,
    "csv_round_trip": csv_round_trip,
    "csv_split_round_trip": csv_split_round_trip,
    "top_segment_sql": top_segment_sql,
    "layer_table": layer_table,
    "published_marts": published_marts,
    "distinct_denominator": distinct_denominator,
    "purchase_reach": purchase_reach,
    "mart_file_round_trip": mart_file_round_trip,
    "mart_parts_round_trip": mart_parts_round_trip,
    "edition_leaves": edition_leaves,
    "missing_dictionary_fields": missing_dictionary_fields,
    "column_map_file": column_map_file,
    "invalid_measure_rows": invalid_measure_rows,
    "prefix_option_adoption": prefix_option_adoption,
}
