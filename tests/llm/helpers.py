"""Small hostile documents, and words as every operator takes them."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DDL = "doc_id long, text string, lang string, source string, n_chars long, _row string, score string, token string, shard string, _key string"


def words(text):
    return WORD.findall(text or "")


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def hostile(spark, seed=1):
    """Copies, near copies, a passage many share, repeated rows, null and empty and blank and very long texts, null
    columns, ties, and extra columns whose names the operators use themselves."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randrange(1, 160)) for _ in range(60)]
    base = prose(rng, 120, 4000)
    passage = prose(rng, 90, 4000)
    for i in range(12):
        w = base.split()
        w[10 * i % len(w)] = f"edit{i}"
        texts += [" ".join(w), f"{prose(rng, 40)} {passage} {prose(rng, 30)}"]
    texts += [base, base + " ", base.replace(" ", "\n"), "Idiot! " + base, "a b", "a b", "été 日本 😀", "x" * 3000]
    texts += [None, None, "", " \t\n", prose(rng, 9000), ("la " * 400).strip(), "\x0b\x0c\r", "a b  c d"]
    rows = [
        (None if i == 7 else i, t, rng.choice(["en", "de", None]), rng.choice(["s0", "s0", "s1", "s2", None]), None if i % 9 == 0 else len(t or ""), "r", "s", "t", "h", "k")
        for i, t in enumerate(texts)
    ]
    rows += [rows[3], rows[3], rows[70]]  # repeated rows
    return rows, spark.createDataFrame(rows, DDL).repartition(5, "doc_id")


def empty(spark):
    return spark.createDataFrame([], DDL)


def stable(df, tmp_dir, name="docs"):
    """``df`` as a table: operators number rows by position."""
    path = f"{tmp_dir}/{name}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def as_multiset(rows):
    return sorted(map(repr, rows))
