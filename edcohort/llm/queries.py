"""The registered queries of this subpackage, each over its whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sql, toxicity
from .bloom_lm import score
from .common import freeze, read_table
from .decontaminate import contamination
from .hard_negatives import mine
from .jaccard_join import jaccard_components
from .licenses import scan_licenses
from .line_dedup import dedup_lines
from .packing import pack
from .prefix_trie import ordered_turns, prefix_trie, with_heads_of
from .quality import quality
from .snapshots import render_maximal
from .wavelet import round_trip
from .window_packing import pack_windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {
    "op4_distinct_site_spread": sql.LINE_DEDUP,
    "op6_benchmark_decontamination": sql.DECONTAMINATION,
    "op10_snapshot_collapse": sql.SNAPSHOTS,
    "op11_segment_hard_negatives": sql.HARD_NEGATIVES,
    "op13_burst_trie": sql.PREFIX_TRIE,
}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_distribution_divergence(spark, sf_dir):
    """Quality counts, base rules and the divergence verdict of each document."""
    return quality(read_table(spark, sf_dir, "documents")).drop("th")


@query
def op4_distinct_site_spread(spark, sf_dir):
    """Each document after the removal of lines found on five sites or more."""
    docs = dedup_lines(read_table(spark, sf_dir, "documents"), details=True)
    return docs.select("doc_id", "n_lines", "n_removed", F.char_length("text").cast("long").alias("n_chars"),
                       F.md5("text").alias("text_md5"))


@query
def op5_ngram_jaccard_join(spark, sf_dir):
    """Near-duplicate component and number of links of each document at Jaccard 0.8 on five-word shingles."""
    return jaccard_components(read_table(spark, sf_dir, "documents"), links=True).drop("th")


@query
def op6_benchmark_decontamination(spark, sf_dir):
    """Words of each document hit by 13-word windows of the benchmark."""
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("th")


@query
def op10_snapshot_collapse(spark, sf_dir):
    """Maximal conversations, rendered; snapshots and repeats of them are gone."""
    out = render_maximal(read_table(spark, sf_dir, "conversations"))
    return out.select("conv_id", "part", "n_turns", "n_copies", F.md5("text").alias("text_md5"))


@query
def op8_conflict_best_fit(spark, sf_dir):
    """The bin and offset of each piece of each document, at 2048 words a bin."""
    return pack(read_table(spark, sf_dir, "documents"))


@query
def op9_log_frequency_bloom(spark, sf_dir):
    """Base and language-model score of each document; a fifth of them is held out."""
    return score(read_table(spark, sf_dir, "documents")).drop("th")


@query
def op1_wavelet_matrix(spark, sf_dir):
    """Position, length and checksum of each document's token ids, read back from the shards."""
    return round_trip(read_table(spark, sf_dir, "documents"), tokenizer_path=tokenizer_path())


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op3_boosted_trees(spark, sf_dir):
    """Toxicity score of each document."""
    return toxicity.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")).drop("th")


@query
def op7_patience_alignment(spark, sf_dir):
    """Best covered license template of each document."""
    out = scan_licenses(read_table(spark, sf_dir, "documents"))
    return out.withColumn("licenses", F.array_join("licenses", ","))


@query
def op11_segment_hard_negatives(spark, sf_dir):
    """Hard negatives of each anchor and positive, among all vectors."""
    v = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(v.withColumn("label", label), F.col("vec_id") % 50 == 0, scale=256.0)


@query
def op12_least_squares_packing(spark, sf_dir):
    """The pieces of each document's token ids in sequences of at most 1024."""
    pieces = pack_windows(read_table(spark, sf_dir, "documents"), tokenizer_path=tokenizer_path(), end=0)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op13_burst_trie(spark, sf_dir):
    """The prefix trie of all conversations, each rebuilt on the first turns of the first one of its five."""
    turns = freeze(ordered_turns(read_table(spark, sf_dir, "conversations")))
    conv = F.col("conv")
    return prefix_trie(*with_heads_of(turns, conv - conv % 5, F.crc32(conv.cast("string").cast("binary")) % 9, 8))
