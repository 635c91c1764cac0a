"""Operator 3: toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features per text: densities of a fixed insult lexicon and of lexicons learned from labelled rows
(whole words, and word beginnings), hits near second-person pronouns, capitals, punctuation and
obfuscation rates, length.  Language, source, id and labels are no features.

Labelled training rows (crc32 of the id as text, modulo 5, not 0; at most ``TRAIN_ROWS`` of them, by
hash order) fall into parts by hash.  The features of a training row use lexicons learned from the other
parts; the trees grow on all parts but one, which calibrates their scores.  All texts are scored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import freeze

#: Labelled rows used for fitting, at most.
TRAIN_ROWS = 20_000
#: Learned lexicon entries at most, and bytes of a word beginning.
LEXICON = 4_000
PREFIX = 5
#: Parts of the training rows: the last one calibrates, the others grow the trees.
PARTS = 5
NEAR = 4

# Insults, and second-person pronouns of four languages.
INSULTS = ["idiot", "idiots", "moron", "morons", "loser", "losers", "stupid", "dumb", "trash", "scum", "clown", "pathetic",
           "worthless", "disgusting", "garbage", "fool", "jerk", "liar", "imbecile", "hate", "shut", "ugly", "vermin",
           "dummkopf", "vollidiot", "abschaum", "wertlos", "crétin", "imbécile", "débile", "ordure", "estúpido", "idiota", "imbécil",
           "basura"]
SECOND_PERSON = ["you", "your", "yours", "yourself", "youre", "ya", "u", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu",
                 "toi", "ton", "ta", "tes", "vous", "votre", "vos", "te", "ti", "tus", "usted", "ustedes", "vosotros"]
# Characters that stand for letters.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a"}
PUNCTUATION = ".,;:!?'\"()-"
SYMBOLS = "#*$%&|<>@^~_+="

_FLAG = lambda chars: np.isin(np.arange(256), [ord(c) for c in chars])
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_LOWER = (np.arange(256) >= 97) & (np.arange(256) <= 122)
_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
_WORD = _UPPER | _LOWER | _DIGIT | _FLAG("@") | (np.arange(256) >= 128)
_STANDS_IN = _FLAG("".join(LEET))
_PUNCT, _SYMBOL, _BANG, _ASK = _FLAG(PUNCTUATION), _FLAG(SYMBOLS), _FLAG("!"), _FLAG("?")


def _table() -> np.ndarray:
    t = T.mix(np.arange(301, 557, dtype=np.uint64))
    t[65:91] = t[97:123]
    for a, b in LEET.items():
        t[ord(a)] = t[ord(b)]
    return t


_MAPPED = _table()
COUNTS = ["words", "bytes", "upper", "lower", "punct", "symbol", "bang", "ask", "digit", "caps", "mixed", "repeat", "seed", "learned",
          "begin", "you", "near"]


def _runs(raw, bounds):
    return T.run_hashes(raw, bounds, _WORD, _MAPPED, PREFIX)


def _hashes(words: list[str]) -> np.ndarray:
    out = []
    for w in words:
        raw = np.frombuffer(w.encode(), np.uint8)
        out.append(int(_runs(raw, np.array([0, len(raw)]))[2][0]))
    return np.unique(np.array(out, np.uint64))


def _in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values


def _near(hit: np.ndarray, you: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Hits with a second-person word at most NEAR words away in the same text."""
    out = np.zeros(len(hit), bool)
    at = np.flatnonzero(hit)
    for step in range(1, NEAR + 1):
        for d in (-step, step):
            other = at + d
            ok = (other >= 0) & (other < len(hit))
            ok[ok] &= you[other[ok]] & (doc[other[ok]] == doc[at[ok]])
            out[at[ok]] = True
    return out


def count_features(texts: pa.Array, seed, you_words, learned, begins) -> np.ndarray:
    """One row of COUNTS per text."""
    out = np.zeros((len(texts), len(COUNTS)), np.int64)
    for i, j, raw, bounds in T.byte_blocks(texts):
        n = j - i
        s, e, whole, begin = _runs(raw, bounds)
        doc = np.searchsorted(bounds, s, side="right") - 1
        owner = np.repeat(np.arange(n), np.diff(bounds))
        per_doc = lambda flag, owner=owner, n=n: np.bincount(owner[flag], minlength=n)
        upto = lambda flag: np.concatenate([[0], np.cumsum(flag)])
        up, stand, low = upto(_UPPER[raw]), upto(_STANDS_IN[raw]), upto(_LOWER[raw])
        size = e - s
        caps = (up[e] - up[s] == size) & (size > 1)
        inside = stand[e] - stand[s]
        mixed = (inside > 0) & (up[e] - up[s] + low[e] - low[s] > 0)
        same = np.zeros(len(raw), bool)
        same[2:] = (raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2]) & (_LOWER | _UPPER)[raw[2:]]
        in_seed, in_learned, in_begin = _in(whole, seed), _in(whole, learned), _in(begin, begins) & (size >= PREFIX)
        you = _in(whole, you_words)
        near = _near(in_seed | in_learned | in_begin, you, doc)
        words = lambda flag, doc=doc, n=n: np.bincount(doc[flag], minlength=n)
        out[i:j] += np.column_stack([
            np.bincount(doc, minlength=n), np.diff(bounds), *[per_doc(f[raw]) for f in (_UPPER, _LOWER, _PUNCT, _SYMBOL, _BANG, _ASK, _DIGIT)],
            words(caps), words(mixed), per_doc(same), words(in_seed), words(in_learned), words(in_begin), words(you), words(near)])
    return out


def dense(c: np.ndarray) -> dict[str, np.ndarray]:
    """Features from counts."""
    k = {name: c[:, n].astype(float) for n, name in enumerate(COUNTS)}
    words, size = np.maximum(k["words"], 1), np.maximum(k["bytes"], 1)
    out = {f"{n}_density": k[n] / words for n in ("seed", "learned", "begin", "you", "near", "caps", "mixed")}
    out |= {f"{n}_rate": k[n] / size for n in ("upper", "punct", "symbol", "bang", "ask", "digit", "repeat")}
    out |= {f"{n}_log": np.log1p(k[n]) for n in ("words", "seed", "learned", "begin", "near")}
    return out


FEATURES = list(dense(np.zeros((1, len(COUNTS)), np.int64)))


def learn_lexicons(sample: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(words, beginnings) much more frequent in toxic texts, for each part k of the sample learned from
    the other parts, and at -1 from all; ``sample`` has (text, toxic, part), bounded."""
    def run(batches):
        for b in T.tidied(batches):
            row = np.asarray(b.column("part"), np.int64) * 2 + np.asarray(b.column("toxic"), np.int64)
            found: list[list] = [[], []]
            for i, _, raw, bounds in T.byte_blocks(b.column("text")):
                s, e, whole, begin = _runs(raw, bounds)
                doc = i + np.searchsorted(bounds, s, side="right") - 1
                long = e - s >= PREFIX
                for kind, h, d in ((0, whole, doc), (1, begin[long], doc[long])):
                    found[kind].append(np.unique(np.stack([h, d.astype(np.uint64)]), axis=1))  # once per text
            for kind in (0, 1):
                if not found[kind]:
                    continue
                h, d = np.concatenate(found[kind], axis=1)
                u, at = np.unique(h, return_inverse=True)
                table = np.bincount(at * 2 * PARTS + row[d.astype(np.int64)], minlength=2 * PARTS * len(u)).reshape(len(u), 2 * PARTS)
                keep = table[:, 1::2].any(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(keep.sum(), kind, np.int32)), pa.array(u[keep].view(np.int64)), *[pa.array(table[keep, c]) for c in range(2 * PARTS)]],
                    names=["kind", "h", *names])

    names = [f"{y}{k}" for k in range(PARTS) for y in ("neg", "pos")]
    total = {(r["part"], r["toxic"]): r["count"] for r in sample.groupBy("part", "toxic").count().collect()}  # 2 * PARTS rows
    counts = sample.mapInArrow(run, ", ".join(["kind int, h long", *[f"{n} long" for n in names]]))
    counts = freeze(counts.groupBy("kind", "h").agg(*[F.sum(n).alias(n) for n in names]))
    out = {}
    for left_out in range(-1, PARTS):
        parts = [k for k in range(PARTS) if k != left_out]
        p, n = (sum(total.get((k, y), 0) for k in parts) for y in (1, 0))
        pos, neg = (sum((F.col(f"{y}{k}") for k in parts), F.lit(0)) for y in ("pos", "neg"))
        odds = ((pos + 0.5) / (p + 1)) / ((neg + 0.5) / (n + 1))
        best = counts.where((pos >= max(3, p // 100)) & (odds >= 8)).orderBy(pos.desc(), "kind", "h").limit(2 * LEXICON)
        got = best.select("kind", "h").toArrow()
        kind, h = np.asarray(got["kind"]), np.asarray(got["h"], np.int64).view(np.uint64)
        out[left_out] = np.sort(h[kind == 0]), np.sort(h[kind == 1])
    return out


def features(docs: DataFrame, lexicons: dict, extra: list[str], part_col: str | None = None) -> DataFrame:
    """``extra`` columns and the dense features of each row of ``docs`` (column text), by the lexicons
    learned without the row's part where ``part_col`` is given, else by those of all rows."""
    sent = docs.sparkSession.sparkContext.broadcast((_hashes(INSULTS), _hashes(SECOND_PERSON), lexicons))

    def run(batches):
        seed, you, lexicons = sent.value
        for b in T.tidied(batches):
            part = np.full(b.num_rows, -1) if part_col is None else np.asarray(b.column(part_col), np.int64)
            for k in np.unique(part):
                own = b.filter(pa.array(part == k))
                d = dense(count_features(own.column("text"), seed, you, *lexicons[int(k)]))
                yield pa.RecordBatch.from_arrays([*[own.column(c) for c in extra], *[pa.array(d[f]) for f in FEATURES]], names=[*extra, *FEATURES])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    return docs.select(*extra, "text").mapInArrow(run, ", ".join([*[f"{c} {kinds[c]}" for c in extra], *[f"{f} double" for f in FEATURES]]))


def score(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          train_rows: int = TRAIN_ROWS, trees: int = 30) -> DataFrame:
    """(doc_id, th, held_out, score, predicted) for each row of ``docs``.

    Null and empty texts have all features 0 and are scored like any other.  Rows without a label, or
    with a null one, are scored only; of several labels of one id the greatest counts, and of several texts one is
    learned from.  Without labels of both kinds in training, the score is the share
    of label 1 there (0 without labels).  Repeated rows give repeated results."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    known = labels.select(F.col(id_col).alias("l_id"), F.col(label_col).cast("int").alias("toxic"))
    known = known.where(F.col("toxic").isin(0, 1) & (F.coalesce(F.crc32(F.col("l_id").cast("string")), F.lit(0)) % 5 != 0))
    known = known.groupBy("l_id").agg(F.max("toxic").alias("toxic"))
    known = freeze(known.withColumn("order", F.xxhash64("l_id")).orderBy("order", "l_id").limit(train_rows))
    known = known.withColumn("part", F.pmod(F.xxhash64(F.lit(3), "l_id"), F.lit(PARTS)).cast("int"))
    near = F.broadcast(known)  # train_rows at most
    # one row of each labelled id, that with the least text hash, so that the sample is bounded however often an id occurs
    sample = d.join(near, d["doc_id"].eqNullSafe(near["l_id"])).groupBy("l_id").agg(F.min_by(F.struct("text", "toxic", "part"), "th").alias("one"))
    sample = freeze(sample.select("one.*"))
    lexicons = learn_lexicons(sample)
    fitted = freeze(features(sample, lexicons, ["toxic", "part"], "part"))
    found = freeze(features(d, lexicons, ["doc_id", "th"]))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    train = assembler.transform(fitted.where(F.col("part") < PARTS - 1).withColumn("label", F.col("toxic").cast("double"))).select("features", "label")
    kinds = {int(r["label"]): r["count"] for r in train.groupBy("label").count().collect()}
    if len(kinds) < 2:
        share = kinds.get(1, 0) / max(1, sum(kinds.values()))
        out = found.withColumn("score", F.lit(float(share)))
    else:
        trees_model = GBTClassifier(maxIter=trees, maxDepth=3, stepSize=0.2, seed=7).fit(train.coalesce(4))
        p = vector_to_array("probability")[1]
        judge = trees_model.transform(assembler.transform(fitted.where(F.col("part") == PARTS - 1))).select(p.alias("p"), F.col("toxic").cast("double").alias("label"))
        out = trees_model.transform(assembler.transform(found)).select("doc_id", "th", p.alias("p"))
        judge = freeze(judge)
        if judge.select("label").distinct().count() == 2:
            calibration = IsotonicRegression(featuresCol="p", labelCol="label", predictionCol="iso").fit(judge.coalesce(1))  # a fifth of train_rows
            # a trace of the trees' own score keeps the order inside a step of the calibration
            out = calibration.transform(out).withColumn("score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.99 * F.col("iso") + 0.01 * F.col("p"))))
        else:
            out = out.withColumn("score", F.col("p"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(0)) % 5 == 0
    return out.select("doc_id", "th", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
