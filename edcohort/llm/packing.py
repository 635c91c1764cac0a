"""Operator 8: conflict-constrained best-fit packing of documents into token sequences.

A bin of ``capacity`` tokens holds at most one document of each source and of each duplicate
cluster; each bin carries a bitmap of either.  Documents go in by falling length: a successor
search in the bins ordered by free space starts at the tightest bin that is large enough and
goes on to the next until one has no conflict; only if there is none, a bin is opened.

Documents longer than a bin are cut into full pieces, which are bins of their own, and a rest
that is packed with the others.  The work is dealt by a hash of the document into shards of
about ``shard_docs`` documents, each packed by one task from ids and lengths (texts are not
moved).  Shards grow in number, not in size.  Repeated rows are counted first and dealt in
runs of ``RUN`` copies, so that a row repeated very often spreads over the shards too.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Copies of a repeated row that go to one shard together.
RUN = 64
WORD_GAPS = r"[\x20\x09-\x0D]+"


def word_count(c: Column) -> Column:
    """Number of words, runs outside U+0020 and U+0009-U+000D; 0 for null."""
    return F.size(F.array_remove(F.split(F.coalesce(c, F.lit("")), WORD_GAPS), ""))


class Bins:
    """Open bins ordered by free space, with their source and cluster bitmaps."""

    def __init__(self, capacity: int):
        self.capacity, self.order, self.sources, self.clusters = capacity, [], [], []

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, offset) of a document whose source and cluster are single-bit masks (0: none)."""
        order, sources, clusters = self.order, self.sources, self.clusters
        for at in range(bisect_left(order, (size, -1)), len(order)):
            free, b = order[at]
            if not (sources[b] & source or clusters[b] & cluster):
                del order[at]
                break
        else:
            b, free = len(sources), self.capacity
            sources.append(0)
            clusters.append(0)
        sources[b] |= source
        clusters[b] |= cluster
        if free > size:
            insort(order, (free - size, b))
        return b, self.capacity - free


def _bits(values: np.ndarray, shared_only: bool) -> list[int]:
    """A mask for each value; 0 for nulls and, with ``shared_only``, for values that occur once."""
    codes, names = pd.factorize(values, use_na_sentinel=True)
    many = np.bincount(codes[codes >= 0], minlength=len(names))
    bit, masks = 0, []
    for k in range(len(names)):
        wanted = many[k] > 1 or not shared_only
        masks.append(1 << bit if wanted else 0)
        bit += wanted
    return [masks[c] if c >= 0 else 0 for c in codes]


def pack_shard(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """The pieces of one shard's documents (doc_id, th, run, copies, length, source, cluster)."""
    rows = rows.loc[rows.index.repeat(rows["copies"])]
    rows = rows.assign(copy=rows["run"] * RUN + rows.groupby(level=0).cumcount())
    rows = rows.assign(rest=rows["length"] % capacity)
    rows = rows.sort_values(["rest", "doc_id", "th", "copy"], ascending=[False, True, True, True], kind="stable")
    sources, clusters = _bits(rows["source"].to_numpy(object), True), _bits(rows["cluster"].to_numpy(object), True)
    bins, out = Bins(capacity), []
    for k, (length, rest) in enumerate(zip(rows["length"].tolist(), rows["rest"].tolist(), strict=True)):
        full = length // capacity
        if not length:
            out.append((k, 0, 0, 0, -1, 0))
        if rest:
            b, at = bins.place(rest, sources[k], clusters[k])
            out.append((k, full, full * capacity, rest, b, at))
    first = len(bins.sources)
    full = rows["length"].to_numpy() // capacity
    owner = np.repeat(np.arange(len(rows)), full)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(full) - full, full)
    whole = np.column_stack([owner, number, number * capacity, np.full(len(owner), capacity), first + np.arange(len(owner)),
                             np.zeros(len(owner), np.int64)])
    table = np.concatenate([np.array(out, np.int64).reshape(-1, 6), whole.astype(np.int64)])
    got = rows.iloc[table[:, 0]][["doc_id", "th", "copy", "source", "cluster", "shard"]].reset_index(drop=True)
    for c, name in enumerate(("piece", "start", "n_tokens", "bin", "bin_offset"), 1):
        got[name] = table[:, c]
    return got


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         cluster_col: str | None = None, length: Column | None = None, capacity: int = 2048, shard_docs: int = 4096) -> DataFrame:
    """(doc_id, copy, piece, start, n_tokens, shard, bin, bin_offset, source, cluster): where each piece of
    each document goes; a bin is named by (shard, bin).

    ``length`` is the number of tokens (default: words); ``cluster_col`` names the duplicate cluster
    (default: equal texts).  A document without tokens (null or empty) has one row with n_tokens 0
    and bin -1.  Null sources and clusters conflict with nothing.  Repeated rows are packed each on
    its own, told apart by ``copy``.  An empty table gives no rows."""
    cluster = F.xxhash64(text_col) if cluster_col is None else F.xxhash64(cluster_col)
    if cluster_col is not None:
        cluster = F.when(F.col(cluster_col).isNotNull(), cluster)
    size = word_count(F.col(text_col)) if length is None else length
    d = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(source_col).cast("string").alias("source"),
                    cluster.alias("cluster"), F.coalesce(size, F.lit(0)).cast("long").alias("length"))
    shards = max(1, -(-docs.count() // shard_docs))
    d = d.groupBy("doc_id", "th", "source", "cluster", "length").agg(F.count("*").alias("many"))
    runs = F.sequence(F.lit(0).cast("long"), F.floor((F.col("many") - 1) / RUN))
    d = d.withColumn("run", F.explode(runs))
    d = d.withColumn("copies", F.least(F.lit(RUN), F.col("many") - F.col("run") * RUN)).drop("many")
    d = d.withColumn("shard", F.pmod(F.xxhash64("doc_id", "th", "source", "run"), F.lit(shards)).cast("int"))
    kind = docs.schema[id_col].dataType.simpleString()
    out = d.groupBy("shard").applyInPandas(
        lambda pdf: pack_shard(pdf, capacity),
        f"doc_id {kind}, th long, copy long, source string, cluster long, shard int, piece long, start long, n_tokens long, "
        "bin long, bin_offset long")
    return out.select("doc_id", "copy", "piece", "start", "n_tokens", "shard", "bin", "bin_offset", "source", "cluster")
