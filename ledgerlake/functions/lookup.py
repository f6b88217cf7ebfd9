"""State -> region / full-name lookup (the location dimension's attributes)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_sized

# ---------------------------------------------------------------------------
# Brazilian federative units (UF code, full name, region) and
# the label used for a code that is unknown or NULL. They must stay exactly as
# written for results to match; listed in the usual alphabetical order of the
# state names.
# ---------------------------------------------------------------------------
UNKNOWN_LABEL = "Não identificado"
STATES = [
    ("AC", "Acre", "Norte"),
    ("AL", "Alagoas", "Nordeste"),
    ("AP", "Amapá", "Norte"),
    ("AM", "Amazonas", "Norte"),
    ("BA", "Bahia", "Nordeste"),
    ("CE", "Ceará", "Nordeste"),
    ("DF", "Distrito Federal", "Centro-Oeste"),
    ("ES", "Espírito Santo", "Sudeste"),
    ("GO", "Goiás", "Centro-Oeste"),
    ("MA", "Maranhão", "Nordeste"),
    ("MT", "Mato Grosso", "Centro-Oeste"),
    ("MS", "Mato Grosso do Sul", "Centro-Oeste"),
    ("MG", "Minas Gerais", "Sudeste"),
    ("PA", "Pará", "Norte"),
    ("PB", "Paraíba", "Nordeste"),
    ("PR", "Paraná", "Sul"),
    ("PE", "Pernambuco", "Nordeste"),
    ("PI", "Piauí", "Nordeste"),
    ("RJ", "Rio de Janeiro", "Sudeste"),
    ("RN", "Rio Grande do Norte", "Nordeste"),
    ("RS", "Rio Grande do Sul", "Sul"),
    ("RO", "Rondônia", "Norte"),
    ("RR", "Roraima", "Norte"),
    ("SC", "Santa Catarina", "Sul"),
    ("SP", "São Paulo", "Sudeste"),
    ("SE", "Sergipe", "Nordeste"),
    ("TO", "Tocantins", "Norte"),
]

REGION_BY_STATE = {uf: region for uf, _, region in STATES}
NAME_BY_STATE = {uf: name for uf, name, _ in STATES}
STATE_CODES = sorted(REGION_BY_STATE)


def map_lookup(col: Column | str, mapping: dict[str, str], default: str = UNKNOWN_LABEL) -> Column:
    """Look ``col`` up in a small fixed mapping; misses and NULL give ``default``.

    The mapping becomes one literal map expression evaluated inside the
    generated code of the stage -- no join, no shuffle, exact match (no trim).
    """
    c = F.col(col) if isinstance(col, str) else col
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), F.lit(default))


def state_attributes(col: Column | str) -> dict[str, Column]:
    """``regiao`` and ``estado_completo`` of a UF code column."""
    return {
        "regiao": map_lookup(col, REGION_BY_STATE),
        "estado_completo": map_lookup(col, NAME_BY_STATE),
    }


def lookup_join(
    df: DataFrame,
    key: str,
    table: DataFrame,
    table_key: str,
    attributes: list[str],
    default: str = UNKNOWN_LABEL,
    max_broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """Attach ``attributes`` from a lookup table that is data, not a constant.

    The table is deduplicated on its key (one attribute set per key, the
    greatest wins) so the lookup can never multiply rows; it is broadcast only
    when its row count is at most ``max_broadcast_rows``, otherwise the join
    shuffles. Misses and NULL keys get ``default``.
    """
    t = table.groupBy(F.col(table_key).alias("__lk")).agg(
        F.max(F.struct(*[F.col(a) for a in attributes])).alias("__lv")
    )
    t = t.select("__lk", *[F.col("__lv")[a].alias(f"__lv_{a}") for a in attributes])
    joined = join_sized(df, t, F.col(key) == F.col("__lk"), "left", max_broadcast_rows)
    out = joined.drop("__lk")
    for a in attributes:
        out = out.withColumn(a, F.coalesce(F.col(f"__lv_{a}"), F.lit(default))).drop(f"__lv_{a}")
    return out
