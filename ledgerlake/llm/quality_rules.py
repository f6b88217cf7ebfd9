"""Operator 5: text-shape rules, then a hashed n-gram likelihood ratio of trusted against raw text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import checkpointed, table, text_of, words_of
from ledgerlake.operators.joins import skew_safe_join

BUCKETS = 16384
SMOOTHING = 1.0
# a document goes when its mean log ratio lies below this: its n-grams are, on the geometric mean,
# a tenth less likely in trusted text than in the raw corpus (junk lies far below, clean text around 0)
THRESHOLD = -0.1


def _held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once: the optimizer doesn't copy it past a generator."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _rest(array: Column, first: int) -> Column:
    return F.slice(array, first, F.greatest(F.size(array) - first + 1, F.lit(0)))


def with_grams(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with the words of a text (_words), their 64-bit hashes (_one) and those of each two in a row (_two)."""
    out = _held(docs, "_words", words_of(text))
    out = _held(out, "_one", F.transform("_words", lambda w: F.xxhash64(w)))
    pairs = F.zip_with(F.slice("_one", 1, F.greatest(F.size("_one") - 1, F.lit(0))), _rest(F.col("_one"), 2), lambda x, y: F.xxhash64(x, y))
    return _held(out, "_two", pairs)


def _with_repeats(df: DataFrame, unique: Column) -> DataFrame:
    """``df`` with n_repeat_words: words in a 3-word window that occurs twice or more.

    Windows are sorted with their place, equal neighbours marked, places put back in order, and each marked
    window adds the words no earlier one covered. Texts without a repeated window skip all of it.
    """
    words, last = F.col("_words"), F.greatest(F.size("_words") - 2, F.lit(0))
    rows = F.arrays_zip(F.slice(words, 1, last).alias("a"), F.slice(words, 2, last).alias("b"), F.slice(words, 3, last).alias("c"))
    pairs = F.transform(rows, lambda x, i: F.struct(F.concat_ws(" ", x["a"], x["b"], x["c"]).alias("w"), i.alias("i")))
    none = F.array().cast("array<struct<w:string,i:int>>")
    df = _held(df, "_order", F.when(unique, none).otherwise(F.sort_array(pairs)))
    order, n = F.col("_order"), F.size("_order")
    one = F.array(F.lit(None).cast("struct<w:string,i:int>"))
    before = F.concat(one, F.slice(order, 1, F.greatest(n - 1, F.lit(0))))
    after = F.concat(F.slice(order, 2, F.greatest(n - 1, F.lit(0))), one)
    df = _held(df, "_near", F.when(n == 0, F.array().cast("array<struct<s:struct<w:string,i:int>,p:struct<w:string,i:int>,q:struct<w:string,i:int>>>")).otherwise(F.arrays_zip(order.alias("s"), before.alias("p"), after.alias("q"))))
    same = F.filter("_near", lambda t: (t["s"]["w"].eqNullSafe(t["p"]["w"])) | (t["s"]["w"].eqNullSafe(t["q"]["w"])))
    df = _held(df, "_places", F.sort_array(F.transform(same, lambda t: t["s"]["i"])))
    count = F.aggregate(
        "_places",
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    return df.withColumn("n_repeat_words", count).drop("_order", "_near", "_places")


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts of the rules, base_failed, and the columns of ``with_grams``."""
    text = text_of(text_col)
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = _held(with_grams(docs, text), "_lines", lines)
    three = F.zip_with(F.slice("_two", 1, F.greatest(F.size("_two") - 1, F.lit(0))), _rest(F.col("_one"), 3), lambda x, y: F.xxhash64(x, y))
    out = _held(out, "_three", three)
    words = F.col("_words")
    # windows of distinct hashes are distinct; any others are compared as text
    unique = F.size(F.array_distinct("_three")) == F.size("_three")
    symbols = sum((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit(""))) for c in "#*$%&|<>"), F.lit(0))
    return (
        _with_repeats(out, unique).withColumn("n_words", F.size(words).cast("long"))
        .withColumn("word_chars", F.length(F.array_join(words, "")).cast("long"))
        .withColumn("n_symbols", symbols.cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
        .drop("_lines", "_three", "_words")
    )


def log_ratios(corpus: DataFrame, trusted: str, text_col: str = "text", buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> DataFrame:
    """One row: the array of log(p_target / p_raw) per bucket, both multinomials smoothed alike.

    ``trusted`` names a boolean column of ``corpus``; the raw counts cover every n-gram of every document, the
    target's those of the trusted ones. They are reduced to ``buckets`` rows in the map tasks.
    """
    grams = with_grams(corpus.select(F.col(trusted).alias("_t"), F.col(text_col).alias("_text")), text_of("_text"))
    grams = grams.select("_t", F.explode(F.concat("_one", "_two")).alias("g"))
    counts = grams.groupBy(F.col("g").bitwiseAND(buckets - 1).alias("b")).agg(
        F.count(F.lit(1)).alias("r"), F.sum(F.when(F.col("_t"), 1).otherwise(0)).alias("t")
    )
    both = corpus.sparkSession.range(buckets).select(F.col("id").alias("b")).join(counts, "b", "left").na.fill(0, ["r", "t"])
    # a row for each bucket, so at most ``buckets`` rows meet here
    one = both.agg(
        F.sum("r").alias("nr"), F.sum("t").alias("nt"), F.array_sort(F.collect_list(F.struct("b", "r", "t"))).alias("c")
    )
    s = float(smoothing)
    ratio = lambda x: F.log((x["t"] + s) / (F.col("nt") + s * buckets)) - F.log((x["r"] + s) / (F.col("nr") + s * buckets))
    return one.select(F.transform("c", ratio).alias("_ratio"))


def marked_corpus(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_text, _t) of each row of ``docs``: whether its id is among the trusted ones, without moving a text.

    Ids alone meet the trusted ones. The rows found come back as bitmaps of 32768 row positions, 4 KB each, one for each such
    stretch of an input partition: about one bit a row, whatever the number of trusted ids.
    """
    row = F.monotonically_increasing_id()
    known = trusted.select(F.col(id_col).alias("_tid")).filter("_tid IS NOT NULL").distinct()
    rows = skew_safe_join(docs.select(row.alias("_row"), F.col(id_col).alias("_tid")), known, "_tid", "inner")
    bits = rows.groupBy(F.bitmap_bucket_number("_row").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_row")).alias("_bits"))
    texts = docs.select(row.alias("_row"), F.col(text_col).alias("_text")).withColumn("_bucket", F.bitmap_bucket_number("_row"))
    at = F.bitmap_bit_position("_row")
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(bitmap_bit_position(_row) div 8 as int) + 1, 1)")), 16, 10).cast("int")
    found = byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), (at % 8 + 1).cast("int"))) != 0
    return texts.join(F.broadcast(checkpointed(bits)), "_bucket", "left").select("_text", F.coalesce(found, F.lit(False)).alias("_t"))


def quality_rules(
    docs: DataFrame,
    trusted: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int = BUCKETS,
    smoothing: float = SMOOTHING,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per row of ``docs``: id, text, the rule counts, base_failed, log_ratio (mean over its n-grams) and kept.

    ``trusted`` holds the ids of texts of the target kind, ``docs`` is the raw corpus. N-grams are the words
    and each two in a row, hashed to ``buckets`` (a power of two). A document is kept when the rules pass
    and log_ratio >= threshold: the verdict depends on its text and the corpus counts alone. Without words
    (null and empty texts) log_ratio is 0 and the rules fail. Without trusted texts the target is uniform up
    to smoothing. Repeated rows get equal results; null ids are never trusted; an empty table gives none. A
    very long text is counted whole. Other columns are ignored, whatever their names.

    Scale: a pass that counts and a pass that scores. What moves is the ids, to meet the trusted ones, and ``buckets``
    counts per task, never a text; what is broadcast is about a bit a row and one array of ``buckets`` doubles.
    """
    docs = docs.select(id_col, text_col)
    ratio = checkpointed(log_ratios(marked_corpus(docs, trusted, id_col, text_col), "_t", "_text", buckets, smoothing))
    out = with_counts(docs, text_col).crossJoin(F.broadcast(ratio))  # one row on the right
    add = lambda a, g: a + F.element_at(F.col("_ratio"), (g.bitwiseAND(buckets - 1) + 1).cast("int"))
    total = F.aggregate("_two", F.aggregate("_one", F.lit(0.0), add), add)
    out = out.withColumn("log_ratio", total / F.greatest(2 * F.col("n_words") - 1, F.lit(1)))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("log_ratio") >= threshold)).drop("_one", "_two", "_ratio")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").filter("quality = 1")
    return quality_rules(table(spark, sf_dir, "documents"), good).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_ratio"
    )
