"""Clean layer: typed, completeness-checked, value-checked, deduplicated, normalised.

Order of the rules: required fields, then amounts, then deduplication -- so a
valid copy of an invoice survives even when a later copy is invalid -- then
trimming. Every dropped row is accounted for with a reason.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.cleaning import DUPLICATE, INVALID_VALUE, NULL_REQUIRED, cast_double, extract_fields, reject_reason, trim_columns
from ..operators.dedupe import latest_per_key

REASON = "reject_reason"


@dataclass(frozen=True)
class SilverRules:
    """What the clean layer extracts and enforces (defaults: the invoice rules)."""

    key: str = "id_nfe"
    fields: list[str] = field(default_factory=lambda: list(S.SILVER_FIELDS))
    amounts: list[str] = field(default_factory=lambda: list(S.AMOUNT_FIELDS))
    required: list[str] = field(default_factory=lambda: list(S.REQUIRED_FIELDS))
    positive: list[str] = field(default_factory=lambda: list(S.POSITIVE_FIELDS))
    non_negative: list[str] = field(default_factory=lambda: list(S.NON_NEGATIVE_FIELDS))
    trimmed: list[str] = field(default_factory=lambda: list(S.TRIMMED_FIELDS))
    order: list[str] = field(default_factory=lambda: list(S.BRONZE_ORDER))  # latest message wins


INVOICE_RULES = SilverRules()


def typed_rows(bronze: DataFrame, rules: SilverRules = INVOICE_RULES) -> DataFrame:
    """Bronze -> one text column per field, amounts as DOUBLE; message position kept."""
    fields = extract_fields(bronze, "payload", rules.fields, keep=rules.order)
    return cast_double(fields, rules.amounts)


def tag_rejects(typed: DataFrame, rules: SilverRules = INVOICE_RULES) -> DataFrame:
    return typed.withColumn(REASON, reject_reason(rules.required, rules.positive, rules.non_negative))


@dataclass
class SilverResult:
    tagged: DataFrame  # every input row with its reject reason (NULL = passed the row rules)
    survivors: DataFrame  # one row per id, message position kept
    silver: DataFrame  # the clean layer, rules.fields
    rules: SilverRules = INVOICE_RULES
    winners: DataFrame | None = None  # id and position of the survivors, worked out without their other fields

    def reject_counts(self, output_rows: int | DataFrame | None = None) -> DataFrame:
        """``stage, rows``: input, null_required, invalid_value, duplicate, output -- one pass.

        ``output_rows`` is the clean layer's row count when it is already known (the
        count observed while writing it, or a one-row DataFrame such as a count of the
        written layer, used as a scalar subquery); then no distinct count over all
        valid ids -- a shuffle of every id -- is needed.
        """
        t = self.tagged
        valid = F.col(REASON).isNull()
        if output_rows is None:
            output = F.count_distinct(F.when(valid, F.col(self.rules.key)))
        elif isinstance(output_rows, DataFrame):
            output = F.first(output_rows.select(F.col(output_rows.columns[0]).cast("long")).scalar())
        else:
            output = F.lit(int(output_rows))
        stats = t.agg(
            F.count(F.lit(1)).alias("input"),
            F.count_if(F.col(REASON) == NULL_REQUIRED).alias(NULL_REQUIRED),
            F.count_if(F.col(REASON) == INVALID_VALUE).alias(INVALID_VALUE),
            F.count_if(valid).alias("__valid"),
            output.alias("output"),
        )
        stats = stats.withColumn(DUPLICATE, F.col("__valid") - F.col("output"))
        stages = ["input", NULL_REQUIRED, INVALID_VALUE, DUPLICATE, "output"]
        return stats.select(
            F.inline(F.array(*[F.struct(F.lit(s).alias("stage"), F.col(s).cast("long").alias("rows")) for s in stages]))
        )

    def quarantine(self) -> DataFrame:
        """Every rejected row with its reason, including the copies that lost deduplication.

        One anti-join of all rows against the surviving message positions: what is
        not a survivor either broke a rule (its reason) or lost to a later copy.
        """
        keys = [self.rules.key] + self.rules.order
        winners = self.survivors.select(*keys) if self.winners is None else self.winners
        t = self.tagged
        rejected = t.join(winners, [t[k].eqNullSafe(winners[k]) for k in keys], "left_anti")
        return rejected.withColumn(REASON, F.coalesce(F.col(REASON), F.lit(DUPLICATE)))


def clean(bronze: DataFrame, rules: SilverRules = INVOICE_RULES, observation: Observation | None = None) -> SilverResult:
    """Bronze rows -> clean layer. ``observation`` gets the row counts of ``observed_counts`` from the pass that writes it."""
    tagged = tag_rejects(typed_rows(bronze, rules), rules)
    counted = tagged
    if observation is not None:
        reason = F.col(REASON)
        counted = tagged.observe(
            observation,
            F.count(F.lit(1)).alias("input"),
            F.count_if(reason == NULL_REQUIRED).alias(NULL_REQUIRED),
            F.count_if(reason == INVALID_VALUE).alias(INVALID_VALUE),
            F.count_if(reason.isNull()).alias("valid"),
        )
    columns = [c for c in tagged.columns if c != REASON]
    survivors = latest_per_key(counted, [rules.key], rules.order, where=F.col(REASON).isNull(), columns=columns)
    silver = trim_columns(survivors, rules.trimmed).select(*rules.fields)
    # the latest position needs no tie-breaking by the other columns: copies that tie have the same one
    winners = latest_per_key(tagged, [rules.key], rules.order, where=F.col(REASON).isNull(), columns=[rules.key, *rules.order])
    return SilverResult(tagged=tagged, survivors=survivors, silver=silver, rules=rules, winners=winners)


def observed_counts(observation: Observation, output_rows: int) -> dict[str, int]:
    """Rows read, per reject reason, and written, in one dictionary."""
    got = observation.get
    return {
        "input": int(got["input"]),
        NULL_REQUIRED: int(got[NULL_REQUIRED]),
        INVALID_VALUE: int(got[INVALID_VALUE]),
        DUPLICATE: int(got["valid"]) - output_rows,
        "output": output_rows,
    }
