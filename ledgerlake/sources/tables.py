"""The given parquet tables, read and cast into the invoice vocabulary.

Role map: invoice = ``orders``; issuer = ``customer`` (CNPJ from the key,
name, segment as town); issuer state = the nation's position in the fixed UF
list (a nation beyond it has no state, which the location dimension reports
as unknown); items = ``lineitem``; issue instant = the order date at
``-03:00``. Amounts: total = ``o_totalprice``; products = the sum of the
order's item prices; discount = the sum of price x discount, to the cent. An
order without items has no product amount and is rejected by the clean layer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from .. import schemas as S
from ..functions.json import record_json
from ..functions.lookup import STATE_CODES
from ..functions.money import money_text, to_money
from ..operators.joins import skew_safe_join
from ..operators.partitioning import ensure_parallelism

TABLE_NAMES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
ISSUE_OFFSET = "-03:00"
ID_DIGITS = 44


# tables whose size grows with the data; a file of one row group reads as one task
SCALED_TABLES = {"orders", "lineitem", "customer", "part", "supplier", "events", "documents", "pages", "conversations"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. A growing table that arrives in fewer splits than there are cores
    is spread round-robin first (never the case for a large multi-file input)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return ensure_parallelism(df) if name in SCALED_TABLES else df


def invoice_id(order_key: Column) -> Column:
    return F.concat(F.lit("NFe"), F.lpad(order_key.cast("string"), ID_DIGITS, "0"))


def issuer_cnpj(cust_key: Column) -> Column:
    return F.lpad(cust_key.cast("string"), 14, "0")


def issue_text(ts: Column) -> Column:
    """Wall-clock ISO text of a TIMESTAMP_NTZ plus the fixed offset.

    Built from the fields, not ``date_format``, which would pass the value
    through the session zone (where a midnight may not exist on a DST day).
    """
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.concat(
        F.to_date(ts).cast("string"), F.lit("T"),
        two(F.hour(ts)), F.lit(":"), two(F.minute(ts)), F.lit(":"), two(F.second(ts)),
        F.lit(ISSUE_OFFSET),
    )


def state_code(nation_key: Column) -> Column:
    codes = F.array(*[F.lit(c) for c in STATE_CODES])
    return F.try_element_at(codes, nation_key.cast("int") + 1)


def order_amounts(lineitem: DataFrame) -> DataFrame:
    """Per order: product total and discount, exact to the cent (map-side partial sums)."""
    price = to_money("l_extendedprice")
    return lineitem.groupBy("l_orderkey").agg(
        F.sum(price).alias("vp"),
        F.round(F.sum(price * F.col("l_discount").cast(DecimalType(4, 2))), 2).alias("vd"),
    )


def issuers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    n = nation.select("n_nationkey")
    c = customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    # a file scan: the optimizer broadcasts it only under the size threshold, judged from
    # the file's size, so no counting job is needed to bound it; if it cannot, a nation
    # holding a large share of the customers is still spread over tasks
    j = skew_safe_join(c, n, c["c_nationkey"] == n["n_nationkey"], "left")
    return j.select(
        "c_custkey",
        issuer_cnpj(F.col("c_custkey")).alias("cnpj_emitente"),
        F.col("c_name").alias("nome_emitente"),
        state_code(F.col("n_nationkey")).alias("uf_emitente"),
        F.col("c_mktsegment").alias("municipio_emitente"),
    )


def invoice_records(spark: SparkSession, sf_dir: str, with_key: bool = False) -> DataFrame:
    """The 16-column text invoice frame, one row per order."""
    orders = read_table(spark, sf_dir, "orders")
    amounts = order_amounts(read_table(spark, sf_dir, "lineitem"))
    iss = issuers(read_table(spark, sf_dir, "customer"), read_table(spark, sf_dir, "nation"))
    o = orders.join(amounts, orders["o_orderkey"] == amounts["l_orderkey"], "left")  # unique keys on both sides
    # a customer may hold a large share of the orders
    o = skew_safe_join(o, iss, o["o_custkey"] == iss["c_custkey"], "left")
    cols = [
        invoice_id(F.col("o_orderkey")).alias("id_nfe"),
        F.col("o_orderkey").cast("string").alias("numero_nfe"),
        F.col("o_orderstatus").alias("serie"),
        issue_text(F.col("o_orderdate")).alias("data_emissao"),
        F.col("o_orderpriority").alias("natureza_operacao"),
        "cnpj_emitente", "nome_emitente", "uf_emitente", "municipio_emitente",
        F.lit(None).cast("string").alias("cpf_destinatario"),
        F.lit(None).cast("string").alias("cnpj_destinatario"),
        F.lit(None).cast("string").alias("nome_destinatario"),
        money_text("vp").alias("valor_produtos"),
        money_text("vd").alias("valor_desconto"),
        money_text("o_totalprice").alias("valor_total_nf"),
        F.concat(F.lit("nfe_"), F.col("o_orderkey").cast("string"), F.lit(".xml")).alias("arquivo_origem"),
    ]
    if with_key:
        cols.append(F.col("o_orderkey"))
    return o.select(*cols)


def invoice_messages(
    spark: SparkSession,
    sf_dir: str,
    publications: int = 2,
    topic: str = "nfe-raw",
    topic_partitions: int = 8,
    records: DataFrame | None = None,
) -> DataFrame:
    """Kafka-shaped records of the invoices, every invoice published ``publications`` times.

    Republishing the whole set is what a scheduled ingest does; the copies are
    identical, later copies have later offsets and timestamps. Key = invoice id
    bytes, value = UTF-8 JSON of the 16 fields (NULLs written), partition =
    hash of the key.
    """
    rec = records if records is not None else invoice_records(spark, sf_dir, with_key=True)
    rec = rec.withColumn("__run", F.explode(F.sequence(F.lit(0), F.lit(publications - 1))))
    return rec.select(
        F.encode("id_nfe", "UTF-8").alias("key"),
        F.encode(record_json(*S.INVOICE_FIELDS), "UTF-8").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.xxhash64("id_nfe"), F.lit(topic_partitions)).cast("int").alias("partition"),
        (F.col("o_orderkey") * publications + F.col("__run")).alias("offset"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_interval(hours=F.col("__run"))).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
