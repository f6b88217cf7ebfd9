"""Star schema: issuer, calendar and location dimensions around a sales fact.

Dimension keys are dense, 1-based and deterministic: they follow the natural
key's order (``cnpj``, date, ``uf``; ``id_nfe`` for the fact), so the same
clean layer always gives the same keys whatever its partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.dates import calendar_parts, instant_local_date, local_date, parse_instant
from ..functions.lookup import lookup_join, state_attributes
from ..operators.dedupe import distinct_values, latest_per_key
from ..operators.joins import DEFAULT_MAX_BROADCAST_ROWS, join_sized
from ..operators.keys import Keyed, with_published_key
from ..session import DEFAULT_TIME_ZONE

DATE_GRAIN = "date"
TIMESTAMP_GRAIN = "timestamp"  # one calendar row per issue instant (the published dimension's grain)


@dataclass(frozen=True)
class StarRoles:
    """Which clean-layer column plays each role (defaults: the invoice clean layer)."""

    invoice: str = "id_nfe"
    issuer: str = "cnpj_emitente"
    issuer_name: str = "nome_emitente"
    issuer_state: str = "uf_emitente"
    issuer_town: str = "municipio_emitente"
    issued_at: str = "data_emissao"  # ISO-8601 text with offset, or TIMESTAMP
    total: str = "valor_total_nf"
    products: str = "valor_produtos"
    discount: str = "valor_desconto"

    def canonical(self, df: DataFrame) -> DataFrame:
        """``df`` with its role columns under the invoice names the builders use."""
        pairs = [
            (self.invoice, "id_nfe"), (self.issuer, "cnpj_emitente"), (self.issuer_name, "nome_emitente"),
            (self.issuer_state, "uf_emitente"), (self.issuer_town, "municipio_emitente"),
            (self.issued_at, "data_emissao"), (self.total, "valor_total_nf"), (self.products, "valor_produtos"),
            (self.discount, "valor_desconto"),
        ]
        if all(src == dst for src, dst in pairs):
            return df
        return df.select(*[F.col(src).alias(dst) for src, dst in pairs])


INVOICE_ROLES = StarRoles()


def dim_emitente(
    silver: DataFrame, num_partitions: int | None = None, roles: StarRoles = INVOICE_ROLES, published: DataFrame | None = None
) -> Keyed:
    """One row per issuer CNPJ; when attributes differ, the latest invoice's win. ``published``: the dimension as it is,
    whose keys stay (for all dimensions and the fact)."""
    src = roles.canonical(silver).select(
        F.col("cnpj_emitente").alias("cnpj"),
        F.col("nome_emitente").alias("nome"),
        F.col("uf_emitente").alias("uf"),
        F.col("municipio_emitente").alias("municipio"),
        parse_instant("data_emissao").alias("__at"),
        F.col("id_nfe").alias("__id"),
    )
    latest = latest_per_key(src, ["cnpj"], ["__at", "__id"]).drop("__at", "__id")
    keyed = with_published_key(latest, "cnpj", "id_emitente", published, num_partitions)
    return Keyed(keyed.df.select(*S.DIM_EMITENTE), keyed.rows)


def dim_data(
    silver: DataFrame,
    time_zone: str = DEFAULT_TIME_ZONE,
    grain: str = DATE_GRAIN,
    num_partitions: int | None = None,
    roles: StarRoles = INVOICE_ROLES,
    published: DataFrame | None = None,
) -> Keyed:
    """Calendar rows of the issue dates: one per date, or one per issue instant with
    ``grain="timestamp"`` (several rows then share a date).

    ``lookup`` maps ``id_data`` to the natural key (``__k``: the date text, or the
    instant) the fact resolves its key with -- always one row per key, so the fact
    never multiplies. An unparseable issue date yields one NULL member that no fact
    row references.
    """
    src = roles.canonical(silver).select(natural_date_key("data_emissao", time_zone, grain).alias("__k"))
    src = distinct_values(src, ["__k"])
    if published is not None:
        if grain != DATE_GRAIN:
            raise ValueError("the published calendar has no instants: its keys can be kept at the date grain only")
        published = published.select("id_data", F.col("data").alias("__k"))
    keyed = with_published_key(src, "__k", "id_data", published, num_partitions)
    day = instant_local_date("__k", time_zone) if grain == TIMESTAMP_GRAIN else F.to_date("__k")
    parts = calendar_parts(day)
    table = keyed.df.select("id_data", *[parts[c].alias(c) for c in S.DIM_DATA[1:]])
    return Keyed(table, keyed.rows, keyed.df.select("id_data", "__k"))


def natural_date_key(col: str, time_zone: str, grain: str) -> Column:
    """The calendar dimension's natural key of an issue instant text."""
    if grain == DATE_GRAIN:
        return local_date(col, time_zone).cast("string")
    if grain == TIMESTAMP_GRAIN:
        return parse_instant(col)
    raise ValueError(f"unknown grain {grain!r}")


def dim_localidade(
    silver: DataFrame,
    num_partitions: int | None = None,
    lookup: DataFrame | None = None,
    roles: StarRoles = INVOICE_ROLES,
    published: DataFrame | None = None,
) -> Keyed:
    """One row per UF code with region and state name; unknown or NULL UF -> the unknown label.

    ``lookup`` (columns ``uf, regiao, estado_completo``) replaces the fixed Brazilian
    table, for locations of another country; it is joined with a size check.
    """
    ufs = distinct_values(roles.canonical(silver).select(F.col("uf_emitente").alias("uf")), ["uf"])
    if lookup is None:
        attrs = ufs.withColumns(state_attributes("uf"))
    else:
        table = lookup.select(F.col("uf").alias("__key"), "regiao", "estado_completo")
        attrs = lookup_join(ufs, "uf", table, "__key", ["regiao", "estado_completo"])
    keyed = with_published_key(attrs, "uf", "id_localidade", published, num_partitions)
    return Keyed(keyed.df.select(*S.DIM_LOCALIDADE), keyed.rows)


def fato_vendas(
    silver: DataFrame,
    emitente: Keyed,
    data: Keyed,
    localidade: Keyed,
    time_zone: str = DEFAULT_TIME_ZONE,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    num_partitions: int | None = None,
    expected_rows: int | None = None,
    grain: str = DATE_GRAIN,
    roles: StarRoles = INVOICE_ROLES,
    published: DataFrame | None = None,
) -> Keyed:
    """One row per invoice with the three dimension keys and rounded amounts.

    Joins are left joins (an unmatched invoice keeps NULL keys). The location
    join is NULL-safe so an invoice without UF points at the NULL member. With
    ``expected_rows`` the row count is checked: a dimension that repeats a
    join key would multiply invoices.
    """
    f = roles.canonical(silver).select(
        "id_nfe",
        "cnpj_emitente",
        "uf_emitente",
        natural_date_key("data_emissao", time_zone, grain).alias("__k"),
        "valor_total_nf",
        "valor_produtos",
        "valor_desconto",
    )
    e = emitente.df.select("id_emitente", F.col("cnpj").alias("cnpj_emitente"))
    f = join_sized(f, e, "cnpj_emitente", "left", max_broadcast_rows, emitente.rows)
    loc = localidade.df.select("id_localidade", F.col("uf").alias("__uf"))
    f = join_sized(f, loc, f["uf_emitente"].eqNullSafe(loc["__uf"]), "left", max_broadcast_rows, localidade.rows)
    f = join_sized(f, data.lookup, "__k", "left", max_broadcast_rows, data.rows)
    f = f.select(
        "id_nfe", "id_emitente", "id_data", "id_localidade",
        F.round("valor_total_nf", 2).alias("valor_total"),
        F.round("valor_produtos", 2).alias("valor_produtos"),
        F.round("valor_desconto", 2).alias("valor_desconto"),
    )
    keyed = with_published_key(f, "id_nfe", "id_venda", published, num_partitions, expected_rows, keep_gone=False)
    if expected_rows is not None and keyed.rows != expected_rows:
        raise AssertionError(f"fact has {keyed.rows} rows for {expected_rows} invoices")
    return Keyed(keyed.df.select(*S.FATO_VENDAS), keyed.rows)


@dataclass
class Star:
    dim_emitente: Keyed
    dim_data: Keyed
    dim_localidade: Keyed
    fato_vendas: Keyed

    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_emitente": self.dim_emitente.df,
            "dim_data": self.dim_data.df,
            "dim_localidade": self.dim_localidade.df,
            "fato_vendas": self.fato_vendas.df,
        }

    def register_views(self, prefix: str = "") -> None:
        for name, df in self.tables().items():
            df.createOrReplaceTempView(prefix + name)


def build_star(
    silver: DataFrame,
    time_zone: str = DEFAULT_TIME_ZONE,
    grain: str = DATE_GRAIN,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    num_partitions: int | None = None,
    check_rows: bool = True,
    location_lookup: DataFrame | None = None,
    roles: StarRoles = INVOICE_ROLES,
    published: dict[str, DataFrame] | None = None,
) -> Star:
    """Clean layer -> the four star tables (each materialised once in the shared folder).

    ``roles`` names the clean-layer columns when they are not the invoice ones. ``published``: the star's tables as they
    were written last; members that they have keep their keys.
    """
    was = published or {}
    e = dim_emitente(silver, num_partitions, roles, was.get("dim_emitente"))
    d = dim_data(silver, time_zone, grain, num_partitions, roles, was.get("dim_data"))
    loc = dim_localidade(silver, num_partitions, location_lookup, roles, was.get("dim_localidade"))
    expected = silver.count() if check_rows else None
    f = fato_vendas(silver, e, d, loc, time_zone, max_broadcast_rows, num_partitions, expected, grain, roles, was.get("fato_vendas"))
    return Star(e, d, loc, f)


def timestamp_grain_fact_rows(df: DataFrame, instant: str, date: str) -> DataFrame:
    """Per calendar date: invoices, distinct issue instants, and the fact rows a calendar
    keyed by instant but joined by date produces (invoices x instants) -- the inflation
    in the published fact table, measured without producing any pair.
    """
    per = df.groupBy(F.col(date).alias("data")).agg(
        F.count(F.lit(1)).alias("notas"),
        F.count_distinct(F.col(instant)).alias("instantes"),
    )
    return per.withColumn("linhas_fato", F.col("notas") * F.col("instantes"))
