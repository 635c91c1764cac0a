"""Operator 4: removal of lines that spread over many sites, by HyperLogLog sketches.

Only DataFrame functions.  Each line (white space at its ends ignored, blank lines never) has
a sketch of the sites it occurs on; sketches merge in the grouped aggregate, map side first,
so a line of a third of all documents shuffles one row per task.  A line whose estimate lies
clearly above ``min_sites`` is boilerplate, one clearly below is not; the sites of those in
between are counted exactly.  Of each boilerplate line the first occurrence (smallest id,
then text hash, then line number) stays, the others go.

Lines are told apart by two 64-bit hashes.  Texts are joined with the line numbers to remove;
while these are few, they are broadcast and no text is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, freeze

#: Sketch size (2**12 registers: relative standard error 1.6 %) and the band around the threshold
#: that is counted exactly (over six standard errors, and two sites at least).
LG_K = 12
BAND = 0.10
#: Boilerplate lines up to which they are broadcast.
SMALL = 200_000
#: Bytes of the line numbers to remove up to which they are broadcast, and of a row without its numbers.
BROADCAST_BYTES, ROW_BYTES = 16_000_000, 48
BLANK = " \t\r\x0b\x0c"


def lines_of(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """(doc_id, th, site, pos, k1, k2) of each line that is not blank."""
    # the text's hash is taken below the explode: once per text, not once per line
    d = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(site_col).alias("site"),
                    F.split(F.col(text_col), "\n").alias("lines"))
    d = d.select("doc_id", "th", "site", F.posexplode_outer("lines").alias("pos", "line"))
    line = F.btrim("line", F.lit(BLANK))
    d = d.select("doc_id", "th", "site", "pos", line.alias("line")).where("line <> ''")
    return d.select("doc_id", "th", "site", "pos", F.xxhash64("line").alias("k1"), F.xxhash64(F.lit(1), "line").alias("k2"))


def boilerplate_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """(k1, k2, first) of the lines on at least ``min_sites`` sites; a null site is none."""
    low = int(min_sites * (1 - BAND)) - 2
    high = int(min_sites * (1 + BAND)) + 2
    found = lines.groupBy("k1", "k2").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"),
                                          F.min(F.struct("doc_id", "th", "pos")).alias("first"))
    found = freeze(found.select("k1", "k2", "first", F.hll_sketch_estimate("sketch").alias("sites"))
                   .where(F.col("sites") > max(low, 0)))
    near = bounded(found.where(F.col("sites") < high).select("k1", "k2"))
    exact = (lines.where("site is not null").join(near, ["k1", "k2"]).select("k1", "k2", "site").distinct()
             .groupBy("k1", "k2").agg(F.count("*").alias("exact")))
    found = found.join(exact, ["k1", "k2"], "left")
    return found.where(F.coalesce("exact", "sites") >= min_sites).select("k1", "k2", "first")


def lines_to_remove(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
                    min_sites: int = 5, keep_first: bool = True) -> DataFrame:
    """(doc_id, th, removed): the 0-based numbers of the lines to remove, per document that has any."""
    lines = lines_of(docs, id_col, text_col, site_col)
    marked = bounded(freeze(boilerplate_lines(lines, min_sites)), SMALL)
    met = lines.join(marked, ["k1", "k2"])
    if keep_first:
        met = met.where(~F.struct("doc_id", "th", "pos").eqNullSafe(F.col("first")))
    return met.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set("pos")).alias("removed"))


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars",
                details: bool = False, **kw) -> DataFrame:
    """``docs`` with repeated cross-site lines removed from the text and, where there is such a
    column, ``chars_col`` set to the new length; with ``details`` also n_lines and n_removed.

    Null texts stay null and empty ones empty; a document may be left with an empty text, but no
    row is dropped.  Repeated rows (same id and text) are one document: they keep or lose the same
    lines.  Rows without a site never make a line spread, but lose lines that spread elsewhere."""
    gone = freeze(lines_to_remove(docs, id_col=id_col, text_col=text_col, **kw)
                  .select(F.col("doc_id").alias("_k_id"), F.col("th").alias("_k_th"), F.col("removed").alias("_gone")))
    n, numbers = gone.agg(F.count("*"), F.coalesce(F.sum(F.size("_gone")), F.lit(0))).first()
    if ROW_BYTES * n + 4 * numbers <= BROADCAST_BYTES:
        gone = F.broadcast(gone)
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row")  # whatever their names
    parts = docs.select(others, F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.split(F.col(text_col), "\n").alias("lines"))
    j = parts.join(gone, parts["doc_id"].eqNullSafe(gone["_k_id"]) & (parts["th"] == gone["_k_th"]), "left")
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("_gone"))
    cut = F.transform(kept, lambda i: F.get("lines", i))
    j = j.withColumn("text", F.array_join(F.when(F.col("_gone").isNull(), F.col("lines")).otherwise(cut), "\n"))
    cols = []
    for c in docs.columns:
        old = F.col("row").getField(c)
        if c == text_col:
            cols.append(F.col("text").alias(c))
        elif c == chars_col:
            new = F.char_length("text").cast(docs.schema[c].dataType)
            cols.append(F.when(F.col("_gone").isNull(), old).otherwise(new).alias(c))
        else:
            cols.append(old.alias(c))
    if details:
        cols += [F.greatest(F.coalesce(F.size("lines"), F.lit(0)), F.lit(0)).cast("long").alias("n_lines"), F.greatest(F.coalesce(F.size("_gone"), F.lit(0)), F.lit(0)).cast("long").alias("n_removed")]
    return j.select(*cols)
