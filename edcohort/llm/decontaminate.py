"""Operator 6: benchmark decontamination with a broadcast set of normalised n-grams.

Only DataFrame functions.  Words are runs of characters outside U+0000-002F, 003A-0060 and
007B-007F after lower-casing A-Z.  An item's windows are its runs of ``n`` words (one window
if it has fewer).  Document windows are generated per position, met with the broadcast
table by a 64-bit hash, and verified word by word in the same join.

The n-gram table is broadcast while it has at most ``BLOCK_WINDOWS`` windows, and texts are not
shuffled then; a larger one is joined with the document windows by hash, and the documents that meet a
window are verified, so no case is dropped and nothing unbounded is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import freeze, keyed, on_keys, without

WORD_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same for texts that still have capitals, and its complement.
RAW_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Windows in the broadcast table; a window of 13 words takes about 250 bytes.
BLOCK_WINDOWS = 200_000


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z only; the fast built-in is the same for texts of ASCII characters."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def words(c: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(lower_ascii(c), F.lit("")), WORD_SEPARATORS), "")


def _hash(words_col: str, start: Column, length: int) -> Column:
    return F.xxhash64(*[F.get(words_col, start + k) for k in range(length)])


def item_windows(items: DataFrame, *, item_col: str = "item_id", text_col: str = "text", n: int = 13) -> DataFrame:
    """(len, win, items): distinct windows, and the ids of the items that hold them, as strings.
    A null id names no item, but its windows count."""
    w = items.select(F.col(item_col).cast("string").alias("item"), words(F.col(text_col)).alias("w"))
    w = w.withColumn("len", F.least(F.size("w"), F.lit(n)))
    at = F.when(F.col("len") > 0, F.sequence(F.lit(0), F.size("w") - F.col("len")))
    w = w.select("item", "len", "w", F.explode_outer(at).alias("p")).where("p is not null")
    return (w.select("item", "len", F.slice("w", F.col("p") + 1, F.col("len")).alias("win"))
            .groupBy("len", "win").agg(F.collect_set("item").alias("items")))


def _meet(docs: DataFrame, block: DataFrame, length: int) -> DataFrame:
    """(doc_id, th, p, len, items) for occurrences of the windows of ``block`` (all of ``length``)."""
    d = docs.select("doc_id", "th", words(F.col("text")).alias("w"))
    at = F.when(F.size("w") >= length, F.sequence(F.lit(0), F.size("w") - length))
    d = d.select("doc_id", "th", "w", F.explode_outer(at).alias("p"))
    d = d.withColumn("h", _hash("w", F.col("p"), length))
    block = F.broadcast(block.select(_hash("win", F.lit(0), length).alias("bh"), "win", "items"))
    met = d.join(block, (d["h"] == block["bh"]) & (F.slice(d["w"], d["p"] + 1, length) == block["win"]))
    return met.select("doc_id", "th", "p", F.lit(length).alias("len"), "items")


def _meet_by_hash(docs: DataFrame, windows: DataFrame, length: int) -> DataFrame:
    """As ``_meet`` for any number of windows: positions and windows are joined by hash, without the texts; what meets is
    then verified word by word, one row per document and text."""
    d = docs.select("doc_id", "th", words(F.col("text")).alias("w"))
    at = F.when(F.size("w") >= length, F.sequence(F.lit(0), F.size("w") - length))
    d = d.select("doc_id", "th", "w", F.explode_outer(at).alias("p")).where("p is not null")
    d = d.select("doc_id", "th", "p", _hash("w", F.col("p"), length).alias("h")).distinct()
    windows = windows.select(_hash("win", F.lit(0), length).alias("bh"), "win", "items")
    met = freeze(d.join(windows, F.col("h") == F.col("bh")).select(F.col("doc_id").alias("m_id"), F.col("th").alias("m_th"), "p", "win", "items"))
    some = met.select(F.col("m_id").alias("s_id"), F.col("m_th").alias("s_th")).distinct()
    whole = docs.join(some, docs["doc_id"].eqNullSafe(some["s_id"]) & (docs["th"] == some["s_th"]), "left_semi").dropDuplicates(["doc_id", "th"])
    whole = whole.select("doc_id", "th", words(F.col("text")).alias("w"))
    j = met.join(whole, met["m_id"].eqNullSafe(whole["doc_id"]) & (met["m_th"] == whole["th"]))
    return j.where(F.slice("w", F.col("p") + 1, length) == F.col("win")).select("doc_id", "th", "p", F.lit(length).alias("len"), "items")


def find_hits(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
              item_col: str = "item_id", item_text_col: str = "text", n: int = 13) -> DataFrame:
    """(doc_id, th, spans, hit_words, item_ids) of the documents with a hit: the (start, length) of
    each occurrence in words, the positions of hit words, and the sorted item ids."""
    keys = keyed(docs, id_col=id_col, text_col=text_col)
    windows = freeze(item_windows(items, item_col=item_col, text_col=item_text_col, n=n))
    sizes = {r["len"]: r["n"] for r in windows.groupBy("len").agg(F.count("*").alias("n")).collect()}  # n rows at most
    met = None
    for length, many in sorted(sizes.items()):
        own = windows.where(F.col("len") == length)
        found = _meet(keys, own, length) if many <= BLOCK_WINDOWS else _meet_by_hash(keys, own, length)
        met = found if met is None else met.union(found)
    if met is None:
        met = keys.where("false").select("doc_id", "th", F.lit(0).alias("p"), F.lit(0).alias("len"),
                                         F.array().cast("array<string>").alias("items"))
    hits = met.groupBy("doc_id", "th").agg(F.collect_set(F.struct("p", "len")).alias("spans"),
                                           F.collect_set("items").alias("items"))
    every = F.flatten(F.transform("spans", lambda s: F.sequence(s["p"], s["p"] + s["len"] - 1)))
    return hits.select("doc_id", "th", "spans", F.array_sort(F.array_distinct(every)).alias("hit_words"),
                       F.array_sort(F.array_distinct(F.flatten("items"))).alias("item_ids"))


def contamination(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  min_percent: int = 5, **kw) -> DataFrame:
    """(doc_id, th, n_words, n_hit, n_items, items_sha256, contaminated) for each row of ``docs``.

    Contaminated: a hit, and 100 * n_hit >= ``min_percent`` * n_words.  Null and empty texts have
    no words and no hits; without items nothing is hit; repeated rows give repeated results."""
    hits = find_hits(docs, items, id_col=id_col, text_col=text_col, **kw).select(
        "doc_id", "th", F.size("hit_words").alias("hit"), F.size("item_ids").alias("its"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("sha"))
    raw = F.array_remove(F.split(F.coalesce(F.col(text_col), F.lit("")), RAW_SEPARATORS), "")
    all_docs = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.size(raw).cast("long").alias("n_words"))
    out = all_docs.join(hits, on_keys(all_docs, hits, "doc_id", "th"), "left")
    out = out.select(all_docs["doc_id"], all_docs["th"], "n_words", F.coalesce("hit", F.lit(0)).cast("long").alias("n_hit"),
                     F.coalesce("its", F.lit(0)).cast("long").alias("n_items"),
                     F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("items_sha256"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= min_percent * F.col("n_words")))


def remove_documents(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` without the contaminated documents."""
    found = contamination(docs, items, id_col=id_col, text_col=text_col, **kw)
    return without(docs, freeze(found.where("contaminated").select("doc_id", "th")), id_col=id_col, text_col=text_col)


def remove_spans(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` with each hit word, and what separates it from the word before, cut out of the text;
    other texts stay as they are, byte for byte."""
    hits = find_hits(docs, items, id_col=id_col, text_col=text_col, **kw)
    hits = freeze(hits.select(F.col("doc_id").alias("_k_id"), F.col("th").alias("_k_th"), F.col("hit_words").alias("_hit")))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")  # whatever the names
    d = docs.select(row, F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.array_remove(F.split(text_col, RAW_SEPARATORS), "").alias("w"),
                    F.split(text_col, RAW_WORD).alias("s"))
    j = d.join(hits, d["doc_id"].eqNullSafe(hits["_k_id"]) & (d["th"] == hits["_k_th"]), "left")
    kept = F.array_except(F.sequence(F.lit(0), F.size("w") - 1), F.col("_hit"))
    pieces = F.transform(kept, lambda i: F.concat(F.get("s", i), F.get("w", i)))
    cut = F.concat(F.array_join(pieces, ""), F.element_at("s", -1))
    old = F.col("row").getField
    return j.select(*[(F.when(F.col("_hit").isNull(), old(c)).otherwise(cut) if c == text_col else old(c)).alias(c) for c in docs.columns])
