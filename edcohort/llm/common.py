"""Helpers shared by the operators of this subpackage.

Conventions that all of them follow:

* A document is identified by (id, 64-bit hash of its text), so rows that repeat an id
  with another text keep results of their own, and repeated rows all get theirs.
* Columns that the caller did not name are never read; working columns are selected
  under fixed names first, so clashing names of extra columns cannot matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import reliable_checkpoint, table_path

#: Rows of a checkpointed key table up to which it is broadcast; beyond, a shuffle join runs.
BROADCAST_ROWS = 1_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def keyed(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, th, text): the id, the hash of the text that tells rows of one id apart, the text."""
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("text"))


def freeze(df: DataFrame) -> DataFrame:
    """Compute once and keep in the shared checkpoint folder."""
    return reliable_checkpoint(df)


#: Rows of a small table that one task handles.
ROWS_PER_TASK = 50_000


def few(df: DataFrame, rows: int) -> DataFrame:
    """``df``, known to have about ``rows`` rows at most, in no more partitions than they need: a small
    table would else write one shuffle file for each of its many near-empty partitions."""
    return df.coalesce(max(1, -(-rows // ROWS_PER_TASK)))


def bounded(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (frozen, narrow) marked for broadcast if it has at most ``max_rows`` rows."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def on_keys(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality of the named columns."""
    out = None
    for n in names:
        c = left[n].eqNullSafe(right[n])
        out = c if out is None else out & c
    return out


def without(docs: DataFrame, drop: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose (id, text hash) is in ``drop`` (doc_id, th; frozen).
    A small ``drop`` is broadcast, so texts are not shuffled; a larger one is joined by key."""
    keys = bounded(drop.select(F.col("doc_id").alias("_k_id"), F.col("th").alias("_k_th")).distinct())
    return docs.join(keys, docs[id_col].eqNullSafe(keys["_k_id"])
                     & (F.xxhash64(docs[text_col]) == keys["_k_th"]), "left_anti")
