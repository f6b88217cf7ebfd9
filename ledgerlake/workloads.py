"""Registered queries: each reads the given tables at ``sf_dir`` (or data Spark derived
from them) and returns a DataFrame.

The invoice engine runs unchanged on the given tables through the role map
of ``sources.tables``: orders become published invoice messages, which go
through the raw, clean and star layers exactly as real invoices do.

Derived data is built once per (application, data folder) and kept in the
shared folder: the invoice records (the content the documents and messages
carry), the raw layer, the clean layer, the star and the gold Parquet. Later
queries of the same session read them, as a deployment reads its layers.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas as S
from .functions.json import record_json
from .functions.lookup import state_attributes
from .functions.money import as_double, money_text, rounded_mean, to_money
from .operators.cleaning import cast_double, extract_fields, filter_required, filter_values, trim_columns
from .operators.dedupe import latest_per_key
from .operators.joins import skew_safe_join
from .operators.keys import Keyed
from .operators.partitioning import ensure_parallelism
from .operators.quality import enforce, quality_report
from .plans import analytics
from .plans.ingest import ingest_documents, ingest_new_documents, read_message_dir
from .plans.items import fact_items
from .plans.layers import load_bronze, load_gold, load_silver, validate_silver
from .plans.ledger import Ledger
from .plans.silver import REASON, SilverResult, clean, typed_rows
from .plans.star import Star, build_star, timestamp_grain_fact_rows
from .session import app_id, file_system, scratch_path
from .sinks.writers import RAW_RECORDS_PER_FILE, read_star, register_tables, save_result, write_bronze, write_observed, write_silver, write_star
from .sinks.xml import (
    document_folders,
    document_without_body,
    invoice_body,
    invoice_document,
    unterminated_document,
    write_document_files,
    write_documents,
)
from .sources.layers import raw_reading, read_bronze, read_silver
from .sources.tables import invoice_id, invoice_messages, invoice_records, issuers, order_amounts, read_table
from .sources.xml import parse_documents, parse_records, read_document_records
from .streaming.incremental import batch_totals, read_rejects, run_incremental_silver, stream_reject_counts

# derived data per (application, data folder, what)
_MEMO: dict[tuple[str, str, str], object] = {}
_MEMO_LOCK = threading.RLock()  # re-entrant: building the star builds the clean layer first


def _memo(spark: SparkSession, sf_dir: str, what: str, build: Callable[[], object]):
    key = (app_id(spark), sf_dir.rstrip("/"), what)
    with _MEMO_LOCK:
        if key not in _MEMO:
            _MEMO[key] = build()
        return _MEMO[key]


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The invoice records derived from the given tables (the content of the documents and
    messages the queries publish), written once to the shared folder and read back."""

    def build():
        path = scratch_path(spark, "invoice_records")
        write_observed(invoice_records(spark, sf_dir, with_key=True), path, "parquet")
        return spark.read.parquet(path)

    return _memo(spark, sf_dir, "records", build)


def _records16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ensure_parallelism(records(spark, sf_dir)).select(*S.INVOICE_FIELDS)


def bronze_path(spark: SparkSession, sf_dir: str) -> str:
    """The invoice messages landed as the JSON raw layer in the shared folder."""

    def build():
        path = scratch_path(spark, "bronze")
        load_bronze(invoice_messages(spark, sf_dir, records=ensure_parallelism(records(spark, sf_dir))), path)
        return path

    return _memo(spark, sf_dir, "bronze_path", build)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_bronze(spark, bronze_path(spark, sf_dir))


def silver_result(spark: SparkSession, sf_dir: str) -> SilverResult:
    return _memo(spark, sf_dir, "silver_result", lambda: clean(bronze(spark, sf_dir)))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean layer written as Parquet in the shared folder, read back."""

    def build():
        path = scratch_path(spark, "silver")
        with raw_reading(spark):
            write_silver(silver_result(spark, sf_dir).silver, path)
        return read_silver(spark, path)

    return _memo(spark, sf_dir, "silver", build)


def star(spark: SparkSession, sf_dir: str) -> Star:
    """The star schema, built only after the clean layer passes the quality gate (as the
    scheduled flow stops before the star on a failed gate). No expected total is
    configured for the given tables, so the gate checks keys, values and NULLs."""

    def build():
        s = silver(spark, sf_dir)
        enforce(quality_report(s, "id_nfe", S.REQUIRED_FIELDS, S.POSITIVE_FIELDS, S.NON_NEGATIVE_FIELDS))
        return build_star(s)

    return _memo(spark, sf_dir, "star", build)


def gold_path(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, int]]:
    """The star written as the Parquet gold layer in the shared folder (folder, rows per table)."""

    def build():
        base = scratch_path(spark, "gold")
        return base, write_star(star(spark, sf_dir).tables(), base)

    return _memo(spark, sf_dir, "gold_path", build)


def gold(spark: SparkSession, sf_dir: str) -> dict[str, Keyed]:
    base, rows = gold_path(spark, sf_dir)
    return read_star(spark, base, rows)


# ---- clean layer -----------------------------------------------------------------
def q_silver_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir)


def q_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per reject reason; the survivors counted from the written clean layer."""
    written = silver(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))
    return silver_result(spark, sf_dir).reject_counts(output_rows=written)


def q_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = read_table(spark, sf_dir, "orders").agg(F.count_distinct("o_orderkey").alias("expected"))
    return quality_report(
        silver(spark, sf_dir), "id_nfe", S.REQUIRED_FIELDS, S.POSITIVE_FIELDS,
        S.NON_NEGATIVE_FIELDS, expected_rows=expected,
    )


# ---- star schema -------------------------------------------------------------------
def q_dim_emitter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir).dim_emitente.df


def q_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir).dim_data.df


def q_dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir).dim_localidade.df


def q_fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir).fato_vendas.df


def q_star_row_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count of each star table, counted from the materialised tables."""
    parts = [
        df.agg(F.count(F.lit(1)).cast("long").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in star(spark, sf_dir).tables().items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- questions ---------------------------------------------------------------------
def q_sales_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = gold(spark, sf_dir)
    return analytics.sales_by_state(g["fato_vendas"], g["dim_localidade"])


def q_top_emitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = gold(spark, sf_dir)
    return analytics.top_emitters(g["fato_vendas"], g["dim_emitente"], g["dim_localidade"])


def q_monthly_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = gold(spark, sf_dir)
    return analytics.monthly_evolution(g["fato_vendas"], g["dim_data"])


def _sql_question(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prefix = "gold_" + app_id(spark).replace("-", "_") + "_"
        for table, keyed in gold(spark, sf_dir).items():
            keyed.df.createOrReplaceTempView(prefix + table)
        return analytics.question_sql(spark, name, prefix)

    return run




# ---- documents and messages ------------------------------------------------------------
def _documents(spark, sf_dir) -> DataFrame:
    """One NF-e document per order of the given tables."""
    rec = _records16(spark, sf_dir)
    return rec.select(invoice_document().alias("value"), "arquivo_origem")


def q_xml_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_documents(_documents(spark, sf_dir)).invoices


def order_items(lineitem: DataFrame, total: Callable[[Column], Column]) -> DataFrame:
    """``l_orderkey, itens``: the items of an order as one array, in the order of their columns; ``total`` gives the text of
    the amount. Lines without an order belong to no other line: each has an array of its own."""
    columns = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    alone = F.when(F.col("l_orderkey").isNull(), F.monotonically_increasing_id()).alias("__alone")
    of_order = lineitem.select("l_orderkey", alone, F.struct(*columns).alias("line")).groupBy("l_orderkey", "__alone").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    nothing = F.lit(None).cast("string")
    items = F.transform(
        "lines",
        lambda i: F.struct(
            i["l_linenumber"].cast("string").alias("numero_item"), i["l_partkey"].cast("string").alias("codigo"),
            nothing.alias("descricao"), i["l_suppkey"].cast("string").alias("ncm"), i["l_linestatus"].alias("cfop"),
            i["l_returnflag"].alias("unidade"), i["l_quantity"].cast("decimal(18,4)").cast("string").alias("quantidade"),
            nothing.alias("valor_unitario"), total(i["l_extendedprice"]).alias("valor_total_item"),
        ),
    )
    return of_order.select("l_orderkey", items.alias("itens"))


def item_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One NF-e document per order, with a ``det`` for each of its line items."""
    orders = order_items(read_table(spark, sf_dir, "lineitem"), money_text)
    heads = orders.select(
        invoice_id(F.col("l_orderkey")).alias("id_nfe"),
        F.concat(F.lit("nfe_"), F.col("l_orderkey").cast("string"), F.lit(".xml")).alias("arquivo_origem"),
        F.col("itens").alias("__items"),
    )
    cols = {c: F.lit(None).cast("string") for c in S.HEADER_FIELDS if c != "id_nfe"}
    return heads.withColumns(cols).select(invoice_document(invoice_body(F.col("__items"))).alias("value"), "arquivo_origem")


def q_xml_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items grouped to one document per order, parsed and exploded to item grain."""
    return parse_documents(item_documents(spark, sf_dir)).items


def q_xml_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of every order, some damaged according to the order's priority class:
    ``5-LOW`` never closes its elements, ``4-NOT SPECIFIED`` carries no invoice body,
    ``3-MEDIUM`` has no identification block. Returns the error side output."""
    rec = _records16(spark, sf_dir)
    pr = F.col("natureza_operacao")
    doc = (
        F.when(pr == "5-LOW", unterminated_document())
        .when(pr == "4-NOT SPECIFIED", document_without_body())
        .when(pr == "3-MEDIUM", invoice_document(invoice_body(include_ide=False)))
        .otherwise(invoice_document())
    )
    return parse_documents(rec.select(doc.alias("value"), "arquivo_origem")).errors


def q_xml_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written many per file and read back with the record reader (files split in parallel)."""
    path = scratch_path(spark, "documents")
    write_documents(_records16(spark, sf_dir), path)
    parsed = parse_records(read_document_records(spark, path))
    return parsed.invoices.drop("arquivo_origem")


def q_message_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents -> parsed records (with items) -> JSON message values -> fields extracted again."""
    rec = parse_documents(_documents(spark, sf_dir)).invoices_with_items
    values = rec.select(record_json(*[c for c in S.INVOICE_WITH_ITEMS.fieldNames()]).alias("payload"))
    return extract_fields(values, "payload", S.INVOICE_FIELDS)


def q_json_payload_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice records -> JSON message values (NULLs written) -> the fields extracted again."""
    values = _records16(spark, sf_dir).select(record_json(*S.INVOICE_FIELDS).alias("payload"))
    return extract_fields(values, "payload", S.INVOICE_FIELDS)


def q_bronze_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze(spark, sf_dir).select("payload", "offset")


def q_topic_not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = bronze(spark, sf_dir)  # the messages as landed: at most one row of one file is read
    return msgs.limit(1).agg(F.count(F.lit(1)).alias("observed")).select(
        F.lit("messages_not_empty").alias("check"), F.col("observed").cast("long"),
        F.lit(1).cast("long").alias("expected"), (F.col("observed") >= 1).alias("passed"),
    )


# ---- single operators on the given tables ---------------------------------------------------
def q_json_extract_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return cast_double(extract_fields(ev, "props", ["k"], keep=["event_id"]), ["k"])


def q_filter_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = typed_rows(bronze(spark, sf_dir))
    kept = filter_required(typed, S.REQUIRED_FIELDS + ["valor_produtos"])
    return kept.select("id_nfe", "offset", *S.AMOUNT_FIELDS)


def q_filter_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return filter_values(cust, ["c_acctbal"], [])


def q_dedupe_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return latest_per_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def q_trim_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return trim_columns(docs, ["text"])


def q_state_region_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    iss = issuers(read_table(spark, sf_dir, "customer"), read_table(spark, sf_dir, "nation"))
    return iss.select("c_custkey", F.col("uf_emitente").alias("uf"), *[
        v.alias(k) for k, v in state_attributes("uf_emitente").items()
    ])


def q_sales_by_state_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The revenue-by-state question through external catalog tables over the gold folders."""
    base, rows = gold_path(spark, sf_dir)
    db = "gold_" + app_id(spark).replace("-", "_")
    register_tables(spark, db, {name: f"{base}/{name}" for name in rows}, database_location=f"{base}/_catalog")
    return analytics.question_sql(spark, "sales_by_state", db + ".")




def q_rounded_mean_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means just below the next cent, of groups of two million and more: for each order n = 2 * key + 2 000 001
    amounts of customer-key cents, and (n - 1) / 2 cents on top."""
    n = 2 * F.col("o_orderkey") + 2_000_001
    cents = (n * F.col("o_custkey") + F.floor((n - 1) / 2)).cast("decimal(30,0)")
    total = (cents * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(34,2)")
    return read_table(spark, sf_dir, "orders").select("o_orderkey", rounded_mean(total, n).alias("ticket_medio"))


# ---- incremental ----------------------------------------------------------------------------
def files_per_batch(spark: SparkSession, path: str) -> int:
    """Raw files of a batch: a compressed file is one task, so one for each core, as long as there are two batches; four at least."""
    fs, files = file_system(spark, f"{path}/part-*")
    return max(4, min(spark.sparkContext.defaultParallelism, len(fs.globStatus(files)) // 2))


def incremental_path(spark: SparkSession, sf_dir: str) -> str:
    """The clean layer built batch by batch, by a streaming query over the raw files."""

    def build():
        out = scratch_path(spark, "silver_incremental")
        raw = bronze_path(spark, sf_dir)
        run_incremental_silver(spark, raw, out, out + "_checkpoint", max_files_per_trigger=files_per_batch(spark, raw))
        return out

    return _memo(spark, sf_dir, "incremental_path", build)


def q_silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_silver(spark, incremental_path(spark, sf_dir), schema=silver_result(spark, sf_dir).silver.schema)


def q_stream_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals that the batches recorded, summed: the same stages as ``reject_counts``."""
    return stream_reject_counts(spark, incremental_path(spark, sf_dir))


def q_stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that broke a rule, as the batches set them aside."""
    return read_rejects(spark, incremental_path(spark, sf_dir)).select("id_nfe", F.col("_pos_offset").alias("offset"), REASON)


def deduplicated_stream(spark: SparkSession, sf_dir: str) -> str:
    """Each publication of the messages landed by itself and followed by a run of the stream that drops what it has seen."""

    def build():
        base = scratch_path(spark, "republished")
        raw = bronze(spark, sf_dir)
        times = [r[0] for r in raw.select("timestamp").distinct().orderBy("timestamp").collect()]  # one per publication
        for k, at in enumerate(times):
            write_bronze(raw.filter(F.col("timestamp") == F.lit(at)), f"{base}/raw/run{k}")
            run_incremental_silver(spark, f"{base}/raw/*", f"{base}/silver", f"{base}/checkpoint", keep_for="24 hours")
        return f"{base}/silver"

    return _memo(spark, sf_dir, "deduplicated_stream", build)


def q_silver_incremental_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_silver(spark, deduplicated_stream(spark, sf_dir), schema=silver_result(spark, sf_dir).silver.schema)


def q_stream_dedupe_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``stage, rows``: messages read, copies dropped in flight, rows written, ids held after the last batch."""
    totals = batch_totals(spark, deduplicated_stream(spark, sf_dir))
    sums = totals.agg(*[F.sum(c).alias(c) for c in ("input", "dropped", "ids")], F.max_by("held", "version").alias("held"))
    return sums.select(F.inline(F.array(*[F.struct(F.lit(c).alias("stage"), F.col(c).cast("long").alias("rows")) for c in sums.columns])))


# ---- accounting, reconciliation, fan-out measure, saved results --------------------------------
def q_quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rejected raw row with its reason (rule breaks and the copies that lost dedupe)."""
    return silver_result(spark, sf_dir).quarantine().select("id_nfe", "offset", REASON)


def q_items_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per invoice: items parsed from the documents summed, against the header product total."""
    items = q_xml_items(spark, sf_dir)
    per = items.groupBy("id_nfe").agg(F.sum(to_money("valor_total_item")).alias("soma_itens"))
    head = records(spark, sf_dir).select("id_nfe", to_money("valor_produtos").alias("valor_produtos"))
    j = per.join(head, "id_nfe", "left")
    return j.select(
        "id_nfe",
        as_double("soma_itens").alias("soma_itens"),
        as_double("valor_produtos").alias("valor_produtos"),
        F.coalesce(F.col("soma_itens") == F.col("valor_produtos"), F.lit(False)).alias("confere"),
    )


def q_fact_sales_timestamp_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows per date a calendar keyed by instant would produce, on the event stream."""
    ev = read_table(spark, sf_dir, "events").select("ts", F.to_date("ts").alias("d"))
    out = timestamp_grain_fact_rows(ev, "ts", "d")
    return out.select(F.col("data").cast("string").alias("data"), "notas", "instantes", "linhas_fato")


def q_sales_by_state_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The revenue-by-state result persisted as CSV with a header and read back."""
    path = scratch_path(spark, "results_sales_by_state")
    result = q_sales_by_state(spark, sf_dir)
    save_result(result, path)
    return spark.read.option("header", "true").schema(result.schema).csv(path)




# ---- layer formats -----------------------------------------------------------------------------
def q_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole table written as Parquet in the shared folder and read back."""
    path = scratch_path(spark, "parquet_roundtrip")
    write_silver(read_table(spark, sf_dir, "orders"), path)
    return read_silver(spark, path)


def q_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole table written as JSON lines and read back with its declared schema."""
    src = read_table(spark, sf_dir, "customer")
    path = scratch_path(spark, "json_roundtrip")
    write_observed(src, path, "json")
    return spark.read.schema(src.schema).json(path)


# ---- the whole flow from documents ------------------------------------------------------------------
def documents_gold(spark: SparkSession, sf_dir: str) -> dict[str, Keyed]:
    """Given tables -> NF-e lot files -> ingest (parse, keyed messages) -> raw -> clean -> gate
    -> star, through files at every stage boundary, with the stage functions the command line runs."""

    def build():
        base = scratch_path(spark, "documents_flow")
        write_documents(_records16(spark, sf_dir), f"{base}/xml")
        ingest_documents(spark, f"{base}/xml", "nfe-raw", f"{base}/messages", None, f"{base}/errors", lots=True)
        load_bronze(read_message_dir(spark, f"{base}/messages"), f"{base}/bronze")
        load_silver(spark, f"{base}/bronze", f"{base}/silver", f"{base}/quarantine")
        validate_silver(spark, f"{base}/silver", None)  # raises before the star on a failed gate
        rows = load_gold(spark, f"{base}/silver", f"{base}/gold")
        return read_star(spark, f"{base}/gold", rows)

    return _memo(spark, sf_dir, "documents_gold", build)


def q_sales_by_state_from_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = documents_gold(spark, sf_dir)
    return analytics.sales_by_state(g["fato_vendas"], g["dim_localidade"])


# ---- documents one file each, read as they come -----------------------------------------------------
DROP_FOLDERS = 8  # each read by a stream of its own


def directory_messages(spark: SparkSession, sf_dir: str) -> str:
    """One file per order, dropped in two goes (by the order's status); the ingest runs after each and reads only the new files."""

    def build():
        base = scratch_path(spark, "directory")
        rec = _records16(spark, sf_dir)
        first = F.col("serie") == "F"
        for drop in (rec.filter(first), rec.filter(~first)):
            write_document_files(drop.select(invoice_document().alias("value"), "arquivo_origem"), f"{base}/xml", folders=DROP_FOLDERS)
            ingest_new_documents(spark, document_folders(f"{base}/xml", DROP_FOLDERS), f"{base}/checkpoint", message_dir=f"{base}/messages")
        return f"{base}/messages"

    return _memo(spark, sf_dir, "directory_messages", build)


def q_xml_directory_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = read_message_dir(spark, directory_messages(spark, sf_dir)).select(F.col("value").cast("string").alias("payload"))
    return extract_fields(messages, "payload", S.INVOICE_FIELDS)


def q_gate_against_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate over the clean layer, held against the valid ids that the publication noted."""

    def build():
        ledger = Ledger(scratch_path(spark, "ledger"))
        for run in ("first", "second"):  # the publication is repeated
            ledger.add_published(_records16(spark, sf_dir), run)
        return ledger

    ledger = _memo(spark, sf_dir, "ledger", build)
    return quality_report(
        silver(spark, sf_dir), "id_nfe", S.REQUIRED_FIELDS, S.POSITIVE_FIELDS, S.NON_NEGATIVE_FIELDS, expected_rows=ledger.expected(spark)
    )


# ---- item grain ---------------------------------------------------------------------------------------
# a message with its items is about twice as long as one without; files are capped as those of the raw layer are
ITEM_RECORDS_PER_FILE = RAW_RECORDS_PER_FILE // 2


def item_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The invoices published with their items, as landed; the items of an order make one document, in the order of their columns."""

    def build():
        of_order = order_items(read_table(spark, sf_dir, "lineitem"), lambda price: price.cast("decimal(18,2)").cast("string"))
        rec = records(spark, sf_dir)
        whole = rec.join(of_order, rec["o_orderkey"] == of_order["l_orderkey"], "left")
        fields = S.INVOICE_WITH_ITEMS.fieldNames()
        path = scratch_path(spark, "item_messages")
        messages = whole.select("o_orderkey", record_json(*fields).alias("payload")).withColumn("run", F.explode(F.array(F.lit(0), F.lit(1))))
        landed = messages.select(
            "payload", F.lit(0).alias("partition"), (F.col("o_orderkey") * 2 + F.col("run")).alias("offset"),
            (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_interval(hours=F.col("run"))).alias("timestamp"),
        )
        write_observed(landed, path, "json", compression="gzip", maxRecordsPerFile=str(ITEM_RECORDS_PER_FILE))
        return path

    return read_bronze(spark, _memo(spark, sf_dir, "item_messages", build))


def item_fact(spark: SparkSession, sf_dir: str) -> Keyed:
    def build():
        messages, sales = item_messages(spark, sf_dir), star(spark, sf_dir).fato_vendas.df
        with raw_reading(spark):
            return fact_items(messages, sales)

    return _memo(spark, sf_dir, "fact_items", build)


def q_fact_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return item_fact(spark, sf_dir).df


def q_items_against_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per invoice: its items net of discount against the header's total, in cents."""
    cents = lambda c: F.round(F.col(c).cast("decimal(20,2)") * 100, 0).cast("long")
    items = item_fact(spark, sf_dir).df.groupBy("id_nfe").agg(
        F.sum(cents("valor_item")).alias("itens_centavos"), F.sum(cents("valor_desconto")).alias("desconto_centavos")
    )
    heads = silver(spark, sf_dir).select("id_nfe", cents("valor_desconto").alias("_discount"), cents("valor_total_nf").alias("total_centavos"))
    return heads.join(items, "id_nfe").select(
        "id_nfe", "itens_centavos", "desconto_centavos", "total_centavos", (F.col("desconto_centavos") == F.col("_discount")).alias("desconto_confere"),
        (F.col("itens_centavos") - F.col("desconto_centavos") == F.col("total_centavos")).alias("total_confere"),
    )


# ---- two loads of the star: published keys stay --------------------------------------------------------
def two_loads(spark: SparkSession, sf_dir: str) -> dict[str, Keyed]:
    """The star over the urgent invoices, and then over all of them with the first one's keys, through the gold folders."""

    def build():
        base = scratch_path(spark, "two_loads")
        s = silver(spark, sf_dir)
        write_silver(s.filter(F.col("natureza_operacao") == "1-URGENT"), f"{base}/silver")
        load_gold(spark, f"{base}/silver", f"{base}/gold")
        write_silver(s, f"{base}/silver")
        return read_star(spark, f"{base}/gold", load_gold(spark, f"{base}/silver", f"{base}/gold"))

    return _memo(spark, sf_dir, "two_loads", build)


def q_dim_emitter_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return two_loads(spark, sf_dir)["dim_emitente"].df


def q_fact_sales_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return two_loads(spark, sf_dir)["fato_vendas"].df


# ---- rules on rows that break them ----------------------------------------------------------------------
def q_gate_on_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five checks over orders as they come: keyed by customer (repeated), products missing where an order has no
    items, balances of zero and below."""
    amounts = order_amounts(read_table(spark, sf_dir, "lineitem"))
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("saldo"))
    o = o.join(amounts, o["o_orderkey"] == amounts["l_orderkey"], "left")
    o = skew_safe_join(o, c, o["o_custkey"] == c["c_custkey"], "left").select("o_custkey", F.col("vp").cast("double").alias("valor"), "saldo")
    expected = read_table(spark, sf_dir, "customer").agg(F.count(F.lit(1)).alias("expected"))
    return quality_report(o, "o_custkey", ["valor"], ["saldo"], ["valor"], expected_rows=expected)


def q_item_text_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of items read from JSON, trimmed, cast and rounded: padded codes (a tab stays), amounts of returned items
    marked so that they are no numbers, eighths that round at the half cent."""
    li = read_table(spark, sf_dir, "lineitem")
    pad = F.concat(F.lit("  "), F.col("l_linestatus"), F.when(F.col("l_returnflag") == "A", F.lit("\t")).otherwise(F.lit(" ")), F.lit(" "))
    amount = F.concat(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), F.when(F.col("l_returnflag") == "R", F.lit(" R")).otherwise(F.lit("")))
    eighths = (F.col("l_quantity") / 8).cast("double").cast("string")
    payload = record_json(pad.alias("codigo"), amount.alias("valor"), eighths.alias("oitavos"))
    keyed = li.select("l_orderkey", "l_linenumber", "l_partkey", payload.alias("payload"))
    fields = extract_fields(keyed, "payload", ["codigo", "valor", "oitavos"], keep=["l_orderkey", "l_linenumber", "l_partkey"])
    return trim_columns(cast_double(fields, ["valor", "oitavos"]), ["codigo"]).withColumn("oitavos", F.round("oitavos", 2))


# ---- registry (order: raw, clean, gate, star, questions, documents, operators, extras) -------------
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_layer": q_bronze_layer,
    "silver_layer": q_silver_layer,
    "reject_counts": q_reject_counts,
    "quality_report": q_quality_report,
    "dim_emitter": q_dim_emitter,
    "dim_date": q_dim_date,
    "dim_location": q_dim_location,
    "fact_sales": q_fact_sales,
    "star_row_totals": q_star_row_totals,
    "sales_by_state": q_sales_by_state,
    "top_emitters": q_top_emitters,
    "monthly_evolution": q_monthly_evolution,
    "sales_by_state_sql": _sql_question("sales_by_state"),
    "top_emitters_sql": _sql_question("top_emitters"),
    "monthly_evolution_sql": _sql_question("monthly_evolution"),
    "xml_header": q_xml_header,
    "xml_items": q_xml_items,
    "xml_errors": q_xml_errors,
    "xml_files": q_xml_files,
    "message_roundtrip": q_message_roundtrip,
    "json_payload_roundtrip": q_json_payload_roundtrip,
    "topic_not_empty": q_topic_not_empty,
    "json_extract_cast": q_json_extract_cast,
    "filter_required": q_filter_required,
    "filter_values": q_filter_values,
    "dedupe_by_key": q_dedupe_by_key,
    "trim_text": q_trim_text,
    "state_region_lookup": q_state_region_lookup,
    "sales_by_state_catalog": q_sales_by_state_catalog,
    "silver_incremental": q_silver_incremental,
    "stream_reject_counts": q_stream_reject_counts,
    "stream_quarantine": q_stream_quarantine,
    "silver_incremental_deduplicated": q_silver_incremental_deduplicated,
    "stream_dedupe_totals": q_stream_dedupe_totals,
    "rounded_mean_boundary": q_rounded_mean_boundary,
    "quarantine_rows": q_quarantine_rows,
    "items_reconciliation": q_items_reconciliation,
    "fact_sales_timestamp_grain": q_fact_sales_timestamp_grain,
    "sales_by_state_saved": q_sales_by_state_saved,
    "sales_by_state_from_documents": q_sales_by_state_from_documents,
    "parquet_roundtrip": q_parquet_roundtrip,
    "json_roundtrip": q_json_roundtrip,
    "xml_directory_stream": q_xml_directory_stream,
    "gate_against_ledger": q_gate_against_ledger,
    "fact_items": q_fact_items,
    "items_against_totals": q_items_against_totals,
    "dim_emitter_two_loads": q_dim_emitter_two_loads,
    "fact_sales_two_loads": q_fact_sales_two_loads,
    "gate_on_orders": q_gate_on_orders,
    "item_text_rules": q_item_text_rules,
}
