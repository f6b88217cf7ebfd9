"""Helpers the operators share: words, exact joins that never shuffle a hot key, written intermediate tables."""

from __future__ import annotations

import atexit
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import ensure_checkpoint_dir, scratch_path

# functions of this package travel to the executors with the job: nothing has to be installed there
cloudpickle.register_pickle_by_value(sys.modules["ledgerlake.llm"])

# the six ASCII white-space characters: the words of every operator are the runs of anything else
SPACES = r"[\x20\x09-\x0D]+"
# a key with more than one row in HOT_SHARE is hot; there are fewer than HOT_SHARE such keys, whatever the input
HOT_SHARE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a text, in order."""
    for c in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(text, " ", -1), "")  # a single character: no pattern is run


def whole_rows(docs: DataFrame) -> DataFrame:
    """``docs`` as one column _doc, with the position _row of each row: no name of a column can clash."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("_doc"), F.monotonically_increasing_id().alias("_row"))


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder (removed by Spark once unused)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups of rows that come sorted by ``key``: no group is cut by the end of a batch (runs inside tasks)."""
    rest: list[pa.Table] = []
    for batch in batches:
        t = pa.Table.from_batches([batch])
        of = t.column(key).to_numpy()
        if not len(of):
            continue
        if rest and rest[0].column(key)[0].as_py() == of[-1]:  # one long group goes on
            rest.append(t)
            continue
        first = int(np.argmax(of == of[-1]))
        if rest or first:
            yield pa.concat_tables([*rest, t.slice(0, first)])
        rest = [t.slice(first)]
    if rest:
        yield pa.concat_tables(rest)


_WRITTEN: list[tuple[SparkSession, str]] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back; removed when the application ends.

    For results of Python passes and wide rows, where a checkpoint would be larger.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    if not _WRITTEN:
        atexit.register(_remove_written)
    _WRITTEN.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def _remove_written() -> None:
    for spark, path in _WRITTEN:
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001 -- the session has gone already
            return


def attach(rows: DataFrame, stats: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """``rows`` joined with ``stats`` (one row per key; every key of ``rows`` is there), safe for hot keys.

    Keys with more than ``total / HOT_SHARE`` rows number fewer than HOT_SHARE, so their statistics are
    broadcast and their rows stay where they are; all other keys meet in a shuffle join, whose largest
    group is then below one row in HOT_SHARE. ``stats`` is read three times: give a materialised frame.
    """
    hot = stats.filter(F.col(count) * HOT_SHARE > total)
    cold = stats.filter(F.col(count) * HOT_SHARE <= total)
    of_hot = rows.join(F.broadcast(hot), keys)
    of_cold = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys)
    return of_hot.unionByName(of_cold)
