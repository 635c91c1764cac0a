"""Operator 2: quality rules by distribution divergence.

Each text gets a histogram over character classes and one over the common words of its
language (plus one bin for all other words).  The reference histograms of each language are
the sums over all documents of that language that pass the base rules, so they cover the
whole corpus; they have a few dozen bins per language.  A document is judged by the
Jensen-Shannon distances (base 2, 0 to 1) of its histograms from its language's references,
given enough characters or words to judge by.

One Arrow pass computes the counts; the references are grouped sums; the distances are
built-in expressions on the histogram columns.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import bounded, freeze, without

# Frequent function words of four languages, the bins of the common-word histogram.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "not", "he",
           "his", "but", "at", "are", "this", "have", "from", "which", "they", "you", "all", "or", "an", "a"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem",
           "nicht", "ein", "eine", "als", "auch", "es", "an", "werden", "aus", "er", "hat", "dass", "sie", "nach"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par",
           "plus", "au", "sur", "pas", "ne", "se", "avec", "son", "il", "ce", "aux", "ou", "sont", "mais"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una", "su",
           "para", "es", "al", "lo", "como", "más", "o", "pero", "sus", "le", "ha", "me", "si"],
}
WORDS = sorted({w for ws in COMMON_WORDS.values() for w in ws})
# The character classes, in the order of their bins.
CLASSES = ["lower", "upper", "digit", "space", "newline", "sentence", "symbol", "other_ascii", "non_ascii"]
SYMBOLS = "#*$%&|<>"
SENTENCE = ".,;:'\"()-"


def _class_table() -> np.ndarray:
    t = np.full(256, CLASSES.index("other_ascii"), np.int64)
    for chars, name in ((map(chr, range(97, 123)), "lower"), (map(chr, range(65, 91)), "upper"), ("0123456789", "digit"),
                        (" \t", "space"), ("\n\r\x0b\x0c", "newline"), (SENTENCE, "sentence"), (SYMBOLS, "symbol")):
        for c in chars:
            t[ord(c)] = CLASSES.index(name)
    t[128:192] = len(CLASSES)  # continuation bytes: no character of their own
    t[192:] = CLASSES.index("non_ascii")
    return t


_CLASS = _class_table()
_IS_SYMBOL = np.isin(np.arange(256), [ord(c) for c in SYMBOLS])
_IS_SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
_IS_CONTINUATION = (np.arange(256) & 0xC0) == 0x80


def repeated_window_words(ids: np.ndarray, n: int = 3) -> int:
    """Words in an n-word window that is found at least twice, the first one included."""
    grams = T.gram_hashes(ids, n)
    if len(grams) < 2:
        return 0
    order = np.argsort(grams, kind="stable")
    s = grams[order]
    same = s[1:] == s[:-1]
    twice = np.zeros(len(s), bool)
    twice[1:] |= same
    twice[:-1] |= same
    if not twice.any():
        return 0
    cover = np.zeros(len(ids) + 1, np.int64)
    at = order[twice]
    np.add.at(cover, at, 1)
    np.add.at(cover, at + n, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if "\n" not in text:
        return 0
    many = Counter(text.split("\n"))
    return sum(c - 1 for line, c in many.items() if c > 1 and line.strip(" \t\n\x0b\x0c\r"))


def features(docs: DataFrame) -> DataFrame:
    """Counts and histograms of (doc_id, th, lang, text) rows; no text leaves the task."""
    hashes = np.array([T.word_hash(w) for w in WORDS], np.uint64)
    order = np.argsort(hashes)
    known, bins = hashes[order], order

    def run(batches):
        for b in T.tidied(batches):
            texts = b.column("text")
            rows = []
            for i, j, h, at in T.hashed_docs(texts, lower=True):
                exact = np.concatenate([x[2] for x in T.hashed_docs(texts.slice(i, j - i), lower=False)])
                where = np.minimum(np.searchsorted(known, h), len(known) - 1)
                common = np.where(known[where] == h, bins[where], len(WORDS))
                for k in range(i, j):
                    lo, hi = int(at[k - i]), int(at[k - i + 1])
                    text = texts[k].as_py() or ""
                    raw = np.frombuffer(text.encode(), np.uint8)
                    chars = np.bincount(_CLASS[raw], minlength=len(CLASSES) + 1)[:len(CLASSES)]
                    rows.append((int(chars.sum()), hi - lo, int((~_IS_SPACE[raw] & ~_IS_CONTINUATION[raw]).sum()), int(_IS_SYMBOL[raw].sum()),
                                 duplicate_lines(text), repeated_window_words(exact[lo:hi]), chars,
                                 np.bincount(common[lo:hi], minlength=len(WORDS) + 1)))
            if rows:
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("th"), b.column("lang"), *[pa.array(c, pa.int64()) for c in cols[:6]],
                     *[pa.array(list(c), pa.list_(pa.int64())) for c in cols[6:]]], names=names)

    names = ["doc_id", "th", "lang", "n_chars", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "chars", "common"]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    return docs.mapInArrow(run, f"doc_id {kinds['doc_id']}, th long, lang {kinds['lang']}, n_chars long, n_words long, word_chars long, n_symbols long, "
                                "n_dup_lines long, n_repeat_words long, chars array<long>, common array<long>")


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, base 2, of two distributions (arrays); null if one is null."""
    def term(x, y):
        m = (x + y) / 2
        part = lambda v: F.when(v > 0, v * F.log2(v / m)).otherwise(F.lit(0.0))
        return (part(x) + part(y)) / 2

    d = F.aggregate(F.zip_with(p, q, term), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(d, F.lit(0.0)))


def references(found: DataFrame) -> DataFrame:
    """(lang, ref_chars, ref_common): distributions over the documents that pass the base rules."""
    def share(name, total, bins):
        return F.array(*[F.try_divide(F.sum(F.get(name, F.lit(k))), F.sum(total)) for k in range(bins)])
    good = found.where(~F.col("base_failed") & F.col("lang").isNotNull())
    return good.groupBy("lang").agg(share("chars", "n_chars", len(CLASSES)).alias("ref_chars"),
                                    share("common", "n_words", len(WORDS) + 1).alias("ref_common"))


def quality(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_words: int = 50,
            max_repeat_percent: int = 50, char_limit: float = 0.15, word_limit: float = 0.22, char_slack: float = 0.3, word_slack: float = 0.6,
            hard_char_limit: float = 0.30, hard_word_limit: float = 0.40, slack: float = 0.8,
            min_chars_to_judge: int = 200, min_words_to_judge: int = 50) -> DataFrame:
    """(doc_id, th, counts, char_distance, word_distance, base_failed, kept) for each row of ``docs``.

    A document is rejected if both distances are over their limits, or one is over its hard limit.  Limits on short texts are wider by a
    slack / sqrt(n_words), for what chance alone adds to a distance: less for the two limits that must be passed
    together (``char_slack``, ``word_slack``) than for the hard ones.  Texts under the minimum lengths have distance 0.  base_failed: fewer than ``min_words`` words, or more than ``max_repeat_percent`` % of them in
    repeated three-word windows.  A null text has no words.  Without a reference (null or unseen
    language) distances are 0 and only the base rules judge.  Repeated rows give repeated results."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(lang_col).alias("lang"),
                    F.col(text_col).alias("text"))
    found = features(d)
    found = found.withColumn("base_failed", (F.col("n_words") < min_words)
                             | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")))
    found = freeze(found)
    def distances(refs):
        refs = bounded(freeze(refs), MAX_LANGUAGES)
        chars = F.transform("chars", lambda x: x / F.col("n_chars"))
        common = F.transform("common", lambda x: x / F.col("n_words"))
        both = {"char_distance": F.when(F.col("n_chars") >= min_chars_to_judge, js_distance(chars, F.col("ref_chars"))),
                "word_distance": F.when(F.col("n_words") >= min_words_to_judge, js_distance(common, F.col("ref_common")))}
        return found.join(refs, "lang", "left").withColumns({k: F.coalesce(v, F.lit(0.0)) for k, v in both.items()})

    chance = F.try_divide(F.lit(1.0), F.sqrt("n_words"))
    margin = slack * chance
    far = F.coalesce(((F.col("char_distance") > char_limit + char_slack * chance) & (F.col("word_distance") > word_limit + word_slack * chance))
                     | (F.col("char_distance") > hard_char_limit + margin)
                     | (F.col("word_distance") > hard_word_limit + margin), F.lit(False))
    refs = references(found)
    for _ in range(REFINEMENTS):  # without the documents far from the reference before
        refs = references(distances(refs).where(~far))
    out = distances(refs)
    return out.select("doc_id", "th", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      (~F.col("base_failed") & ~far).alias("kept"), "char_distance", "word_distance")


#: Times the references are made again from the documents that are not far from them.
REFINEMENTS = 1
#: Languages whose references (under 1 kB each) are broadcast.
MAX_LANGUAGES = 10_000


def keep_good(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` without the rejected documents."""
    found = quality(docs, id_col=id_col, text_col=text_col, **kw)
    return without(docs, freeze(found.where("not kept").select("doc_id", "th")), id_col=id_col, text_col=text_col)
