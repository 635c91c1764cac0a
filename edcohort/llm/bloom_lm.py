"""Operator 9: language-model scores from a log-frequency Bloom filter.

The filter holds quantised counts of words and word pairs: an n-gram with count c is entered
once for each level 1..1 + floor(log_b c), and a query probes rising levels until one is
missing.  Word pairs that occur once are left out (``min_count`` of pairs is 2, at any size); the
filter grows with the input.

1. *Counting.* Each task counts the words and pairs of its training texts and emits, per hash
   bucket, the sorted 32-bit rests of the hashes and their counts; buckets grow in number
   with the input and are merged one by one.  Words are also counted exactly by their 64-bit
   hash, for the base score.
2. *Building.* Each bucket has a segment of the filter of its own, made by one task.  Up to
   ``MAX_ENTRIES`` entries the segments are joined into one array and broadcast.  Beyond, they
   stay a table: groups of texts send their distinct hashes, by bucket, to the segments and get
   the levels back (``probed``); steps 3 and 4 then work on the levels of each document's tokens.
3. *Tuning.* The weight of the pair estimate, per power of two of the history's count,
   is fitted to all training texts with each pair's own occurrence left out; tasks return one
   small table of counts by (weight class, likelihood ratio).
4. *Scoring.* log10 P(w | v) = log10(a c(v,w) / c(v) + (1 - a) (c(w) + 0.5) / (N + 0.5 (V + 1))), all c
   from probes.  The base score needs exact counts: those of the most frequent words (a bounded
   table) are broadcast, occurrences of other words are joined with the exact counts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import freeze

_U = np.uint64
BASE = 1.5
#: Entries (n-gram, level) up to which the filter is broadcast; 12 bits each, so 50 MB.
MAX_ENTRIES = 1 << 25
BITS_PER_ENTRY = 12
#: Words whose exact counts are broadcast (16 bytes each).
FREQUENT_WORDS = 1 << 19
#: Tokens per bucket of the n-gram counts, about.
BUCKET_TOKENS = 1_000_000
#: The end token; a fixed number, so no word of a text is taken for it.
END = 0x2D358DCCAA6C78A5
PAIR = _U(0x8CB92BA72F3D8DD7)
LOG_BASE = math.log(BASE)
_THRESHOLDS = np.unique(np.ceil(BASE ** np.arange(0, 60) - 1e-9).astype(np.int64))


def levels(counts: np.ndarray) -> np.ndarray:
    """1-based level of each count: the number of distinct integer thresholds ceil(b**k) up to it."""
    return np.searchsorted(_THRESHOLDS, counts, side="right")


def level_values() -> np.ndarray:
    """What a level stands for: 0 for level 0, else the middle of its counts."""
    low = _THRESHOLDS[:-1].astype(float)
    return np.concatenate([[0.0], np.sqrt(low * (_THRESHOLDS[1:] - 1))])


_VALUES = level_values()


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return T.mix(first * _U(0x9E3779B97F4A7C15) + second + PAIR)


def split_key(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, 32-bit rest) of 64-bit hashes."""
    return ((h >> _U(32)) % _U(buckets)).astype(np.int64), (h & _U(0xFFFFFFFF)).astype(np.uint32)


@dataclass
class Filter:
    """A Bloom filter in ``buckets`` segments of ``words`` 64-bit words; an entry sets four bits of one."""

    bits: np.ndarray  # empty when the segments stay a table
    buckets: int
    words: int
    least: int = 2  # levels below this are not stored for pairs
    first: int = 1  # and for words

    @staticmethod
    def place(rest: np.ndarray, level, words: int) -> tuple[np.ndarray, np.ndarray]:
        h = T.mix(rest.astype(np.uint64) | (np.asarray(level, np.uint64) << _U(33)))
        mask = np.zeros(len(h), np.uint64)
        for k in range(4):
            mask |= _U(1) << ((h >> _U(6 * k)) & _U(63))
        return ((h >> _U(24)) % _U(words)).astype(np.int64), mask

    @staticmethod
    def probe(bits: np.ndarray, bucket: np.ndarray, rest: np.ndarray, words: int, start: int) -> np.ndarray:
        """Level of each (bucket, rest); levels are probed from ``start`` on."""
        level = np.zeros(len(rest), np.int64)
        alive = np.arange(len(rest))
        for j in range(start, len(_VALUES)):
            at, mask = Filter.place(rest[alive], j, words)
            alive = alive[(bits[bucket[alive] * words + at] & mask) == mask]
            if not len(alive):
                break
            level[alive] = j
        return level

    def value(self, h: np.ndarray, start: int) -> np.ndarray:
        """Quantised count of each hash."""
        bucket, rest = split_key(h, self.buckets)
        return _VALUES[self.probe(self.bits, bucket, rest, self.words, start)]


def _documents(batch, is_training=None):
    """(row, tokens) with the end token, for rows of a batch; the end is one token of its own."""
    for i, j, h, at in T.hashed_docs(batch.column("text")):
        keep = range(j - i) if is_training is None else [k for k in range(j - i) if is_training[i + k]]
        for k in keep:
            yield i + k, np.append(h[at[k]:at[k + 1]], _U(END))


def _pairs(tokens: np.ndarray) -> np.ndarray:
    """Pair hashes of a text that starts after an end."""
    return pair_hashes(np.concatenate([[_U(END)], tokens[:-1]]), tokens)


def _counted(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = np.sort(h)
    edge = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    return h[edge], np.diff(np.append(edge, len(h)))


def counted_words(docs: DataFrame) -> DataFrame:
    """(token, c): exact counts of the words of the training texts, by 64-bit hash."""
    def run(batches):
        for b in T.tidied(batches):
            found = [t for _, t in _documents(b)]
            if found:
                h, c = _counted(np.concatenate(found))
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], names=["token", "c"])

    return docs.mapInArrow(run, "token long, c long").groupBy("token").agg(F.sum("c").alias("c"))


def counted_ngrams(docs: DataFrame, buckets: int) -> DataFrame:
    """(size, bucket, rests, counts): merged counts of words (size 1) and of pairs that occur twice or more."""
    def emit(size, h):
        h, c = _counted(h)
        bucket, rest = split_key(h, buckets)
        order = np.lexsort((rest, bucket))
        bucket, rest, c = bucket[order], rest[order], c[order].astype(np.uint32)
        edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
        return [(size, int(bucket[a]), rest[a:z].tobytes(), c[a:z].tobytes()) for a, z in zip(edge[:-1], edge[1:], strict=True)]

    def run(batches):
        for b in T.tidied(batches):
            found = [t for _, t in _documents(b)]
            if found:
                rows = emit(1, np.concatenate(found)) + emit(2, np.concatenate([_pairs(t) for t in found]))
                s, k, r, c = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(s, pa.int32()), pa.array(k, pa.int64()), pa.array(r, pa.binary()),
                                                  pa.array(c, pa.binary())], names=["size", "bucket", "rests", "counts"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        rest = np.frombuffer(b"".join(pdf["rests"]), np.uint32)
        c = np.frombuffer(b"".join(pdf["counts"]), np.uint32).astype(np.int64)
        order = np.argsort(rest, kind="stable")
        rest, c = rest[order], c[order]
        edge = np.flatnonzero(np.concatenate([[True], rest[1:] != rest[:-1]]))
        rest, c = rest[edge], np.add.reduceat(c, edge)
        size = int(pdf["size"].iloc[0])
        keep = c >= size  # pairs: twice or more
        return pd.DataFrame({"size": [size], "bucket": [int(pdf["bucket"].iloc[0])], "rests": [rest[keep].tobytes()],
                             "counts": [c[keep].tobytes()],
                             "by_level": [np.bincount(levels(c[keep]), minlength=len(_VALUES)).tolist()]})

    rows = docs.mapInArrow(run, "size int, bucket long, rests binary, counts binary")
    return rows.groupBy("size", "bucket").applyInPandas(
        merge, "size int, bucket long, rests binary, counts binary, by_level array<long>")


def build_filter(ngrams: DataFrame, buckets: int, max_entries: int) -> tuple[Filter, DataFrame | None]:
    """The filter; with more than ``max_entries`` entries its bits are a frozen table (bucket, bits)."""
    bins = len(_VALUES)
    got = ngrams.groupBy("size").agg(*[F.sum(F.get("by_level", F.lit(k))).alias(f"l{k}") for k in range(bins)]).collect()  # 2 rows
    first = {1: Filter.first, 2: Filter.least}
    total = sum(r[f"l{k}"] * max(k - first[r["size"]] + 1, 0) for r in got for k in range(bins))
    size = max(1, -(-total * BITS_PER_ENTRY // (64 * buckets)))

    def segment(pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(size, np.uint64)
        for s, rests, counts in zip(pdf["size"], pdf["rests"], pdf["counts"], strict=True):
            rest, top = np.frombuffer(rests, np.uint32), levels(np.frombuffer(counts, np.int64))
            for j in range(first[s], int(top.max(initial=0)) + 1):
                at, mask = Filter.place(rest[top >= j], j, size)
                np.bitwise_or.at(bits, at, mask)
        return pd.DataFrame({"bucket": [int(pdf["bucket"].iloc[0])], "bits": [bits.tobytes()]})

    segments = ngrams.groupBy("bucket").applyInPandas(segment, "bucket long, bits binary")
    if total > max_entries:
        return Filter(np.empty(0, np.uint64), buckets, size), freeze(segments)
    bits = np.zeros(size * buckets, np.uint64)
    for r in segments.toLocalIterator():  # bounded by max_entries
        bits[r["bucket"] * size:(r["bucket"] + 1) * size] = np.frombuffer(r["bits"], np.uint64)
    return Filter(bits, buckets, size), None


@dataclass
class Model:
    filter: Filter
    tokens: int  # N
    words: int  # V
    frequent: np.ndarray  # sorted hashes of the words whose exact counts are known here
    counts: np.ndarray
    complete: bool  # whether these are all words
    weights: np.ndarray  # of the pair estimate, by log2 of the history's count
    segments: DataFrame | None = None  # of a filter that is not broadcast

    def sent(self, sc):
        """The model without its table, broadcast."""
        return sc.broadcast(replace(self, segments=None))

    def base(self, c):
        return np.log10((c + 0.5) / (self.tokens + 0.5 * (self.words + 1)))

    def exact(self, h: np.ndarray) -> np.ndarray:
        """Exact counts; -1 where they are not known here."""
        if not len(self.frequent):
            return np.full(len(h), 0 if self.complete else -1)
        at = np.minimum(np.searchsorted(self.frequent, h), len(self.frequent) - 1)
        return np.where(self.frequent[at] == h, self.counts[at], 0 if self.complete else -1)

    def estimates(self, texts: list[np.ndarray], left_out: int = 0):
        """(word, word index, class, pair estimate, word estimate) of all tokens of some texts; with
        ``left_out`` 1 each token's own occurrence does not count."""
        tokens = np.concatenate(texts)
        word, index = np.unique(tokens, return_inverse=True)
        before = np.concatenate([np.concatenate([[_U(END)], t[:-1]]) for t in texts])
        pair, pair_index = np.unique(pair_hashes(before, tokens), return_inverse=True)
        c_word = self.filter.value(word, self.filter.first)
        c_pair = self.filter.value(pair, self.filter.least)[pair_index]
        at = np.searchsorted(word, before)
        at = np.where((at < len(word)) & (word[np.minimum(at, len(word) - 1)] == before), at, -1)
        end = self.filter.value(np.array([END], np.uint64), self.filter.first)[0]
        return word, index, *self.by_counts(c_word[index], c_pair, np.where(at >= 0, c_word[at], end), left_out)

    def by_counts(self, c_word, c_pair, c_before, left_out: int = 0):
        """(class, pair estimate, word estimate) from quantised counts."""
        c_pair = np.minimum(c_pair, c_before)
        one = (np.maximum(c_word - left_out, 0) + 0.5) / (self.tokens + 0.5 * (self.words + 1))
        two = np.maximum(c_pair - left_out, 0) / np.maximum(c_before - left_out, 1)
        kind = np.minimum(np.log2(np.maximum(c_before, 1)).astype(np.int64), len(self.weights) - 1)
        return kind, two, one

    def by_levels(self, codes: bytes, left_out: int = 0):
        """``by_counts`` of packed levels (``pack_levels``)."""
        code = np.frombuffer(codes, np.int32)
        return self.by_counts(_VALUES[code & 63], _VALUES[code >> 12], _VALUES[code >> 6 & 63], left_out)


#: Likelihood ratios are counted in quarter powers of two from 2**-10 to 2**40; cell 0 is a ratio of 0.
RATIO_LOW, RATIO_CELLS = -40, 202
KINDS = 32


def _ratio_cells(two, one):
    cell = np.clip(np.round(4 * np.log2(np.maximum(two, 1e-300) / one)).astype(np.int64) - RATIO_LOW + 1, 1, RATIO_CELLS - 1)
    return np.where(two > 0, cell, 0)


def tuned_weights(docs: DataFrame, model) -> np.ndarray:
    """Weights with the greatest likelihood of the training texts, each token left out of its own counts.
    ``docs`` has their texts or their levels (``probed``)."""
    by_text = "text" in docs.columns

    def estimates(b):
        if by_text:
            for texts in _groups(_documents(b)):
                _, _, kind, two, one = model.value.estimates([t for _, t in texts], left_out=1)
                yield kind, two, one, None
        else:
            for codes, times in zip(b.column("codes"), b.column("times"), strict=True):
                yield *model.value.by_levels(codes.as_py(), left_out=1), np.frombuffer(times.as_py(), np.int32)

    def run(batches):
        table = np.zeros(KINDS * RATIO_CELLS, np.int64)
        for b in T.tidied(batches):
            for kind, two, one, times in estimates(b):
                at, of = np.unique(kind * RATIO_CELLS + _ratio_cells(two, one), return_inverse=True)
                table[at] += np.bincount(of, times, minlength=len(at)).astype(np.int64)
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(table[at])], names=["cell", "n"])

    got = docs.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()  # KINDS * RATIO_CELLS at most
    table = np.zeros(KINDS * RATIO_CELLS)
    for r in got:
        table[r["cell"]] = r["n"]
    table = table.reshape(KINDS, RATIO_CELLS)
    ratio = np.concatenate([[0.0], 2.0 ** ((np.arange(1, RATIO_CELLS) - 1 + RATIO_LOW) / 4)])
    weights = np.full(KINDS, 0.05)
    for k in range(KINDS):
        n = table[k].sum() + 1
        for _ in range(100):
            share = weights[k] * ratio / (weights[k] * ratio + 1 - weights[k])
            weights[k] = np.clip(((table[k] * share).sum() + 0.05) / n, 1e-4, 0.999)
    return weights


def _groups(found, most: int = 500_000):
    """Lists of (row, tokens) with about ``most`` tokens together, a longer text alone."""
    group, size = [], 0
    for x in found:
        group.append(x)
        size += len(x[1])
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group


def pack_levels(word: np.ndarray, pair: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Levels of a token, its pair and the token before it in one number."""
    return (pair << 12 | before << 6 | word).astype(np.int32)


def probed(d: DataFrame, model: Model) -> DataFrame:
    """(doc_id, th, held_out, codes, times): the packed levels of each row's tokens and how often they occur,
    from the segments of the filter.

    Texts are hashed in groups.  A group has one row of state (its documents, each token's pair as an
    index, and each pair's words), and one row of distinct hashes for each bucket it asks.  Both are
    frozen; a segment answers a byte for each hash, and the state meets the answers of its group."""
    f, kind = model.filter, d.schema["doc_id"].dataType.simpleString()

    def by_bucket(h):
        """(bucket, rest, order, rank): hashes dealt to buckets, and where each of them went."""
        bucket, rest = split_key(h, f.buckets)
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(h), np.uint32)
        rank[order] = np.arange(len(h), dtype=np.uint32)
        return bucket[order], rest[order], order, rank

    def ask(batches):
        group = TaskContext.get().partitionId() << 32
        for b in T.tidied(batches):
            for texts in _groups(_documents(b)):
                tokens = np.concatenate([t for _, t in texts])
                before = np.concatenate([np.concatenate([[_U(END)], t[:-1]]) for _, t in texts])
                word, index = np.unique(tokens, return_inverse=True)  # a token before another is one too, the end as well
                pair, where, pair_index = np.unique(pair_hashes(before, tokens), return_index=True, return_inverse=True)
                word_bucket, word_rest, _, word_rank = by_bucket(word)
                pair_bucket, pair_rest, order, pair_rank = by_bucket(pair)
                where = where[order]
                state = [np.array([len(t) for _, t in texts], np.int64), pair_rank[pair_index], word_rank[index[where]],
                         word_rank[np.searchsorted(word, before[where])]]
                size, buckets, rests = [0], [0], [None]
                for s, bucket, rest in ((1, word_bucket, word_rest), (2, pair_bucket, pair_rest)):
                    edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
                    size += [s] * (len(edge) - 1)
                    buckets += bucket[edge[:-1]].tolist()
                    rests += [rest[a:z].tobytes() for a, z in zip(edge[:-1], edge[1:], strict=True)]
                none = [None] * (len(size) - 1)
                rows = pa.array([r for r, _ in texts])
                lists = []
                for name in ("doc_id", "th", "held_out"):
                    own = b.column(name).take(rows)
                    lists.append(pa.concat_arrays([pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own),
                                                   pa.nulls(len(none), pa.list_(own.type))]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([group] * len(size), pa.int64()), pa.array(size, pa.int32()), pa.array(buckets, pa.int64()), pa.array(rests, pa.binary()),
                     *lists, pa.array([[x.tobytes() for x in state], *none], pa.list_(pa.binary()))], names=names)
                group += 1

    names = ["grp", "size", "bucket", "rests", "doc_ids", "ths", "held", "state"]
    asked = freeze(d.mapInArrow(ask, f"grp long, size int, bucket long, rests binary, doc_ids array<{kind}>, ths array<long>, held array<boolean>, "
                                     "state array<binary>"))

    def answer(segment: pa.Table, wanted: pa.Table) -> pa.Table:
        bits = np.frombuffer(segment["bits"][0].as_py(), np.uint64) if len(segment) else np.zeros(f.words, np.uint64)
        out: list = [b""] * len(wanted)
        sizes, rests = wanted["size"].to_numpy(), wanted["rests"].to_pylist()
        for s, start in ((1, f.first), (2, f.least)):
            rows = np.flatnonzero(sizes == s)
            if len(rows):
                rest = np.frombuffer(b"".join(rests[k] for k in rows), np.uint32)
                level = Filter.probe(bits, np.zeros(len(rest), np.int64), rest, f.words, start).astype(np.uint8).tobytes()
                edge = np.cumsum([0, *[len(rests[k]) // 4 for k in rows]])
                for k, a, z in zip(rows, edge[:-1], edge[1:], strict=True):
                    out[k] = level[a:z]
        return wanted.select(["grp", "size", "bucket"]).append_column("levels", pa.array(out, pa.binary()))

    def meet(state: pa.Table, answers: pa.Table) -> pa.Table:
        n, pair_index, word_of, before_of = (np.frombuffer(x, t) for x, t in zip(
            state["state"][0].as_py(), (np.int64, np.uint32, np.uint32, np.uint32), strict=True))
        answers = answers.sort_by([("size", "ascending"), ("bucket", "ascending")])
        sizes, levels_ = answers["size"].to_numpy(), answers["levels"].to_pylist()
        word, pair = (np.frombuffer(b"".join(levels_[k] for k in np.flatnonzero(sizes == s)), np.uint8).astype(np.int64) for s in (1, 2))
        code = pack_levels(word[word_of], pair, word[before_of])[pair_index]
        found = [np.unique(c, return_counts=True) for c in np.split(code, np.cumsum(n)[:-1])]
        own = [state[c].combine_chunks().flatten() for c in ("doc_ids", "ths", "held")]
        return pa.Table.from_arrays([*own, pa.array([c.tobytes() for c, _ in found], pa.binary()),
                                     pa.array([m.astype(np.int32).tobytes() for _, m in found], pa.binary())],
                                    names=["doc_id", "th", "held_out", "codes", "times"])

    probes = asked.where("size > 0").select("grp", "size", "bucket", "rests")
    answers = model.segments.groupBy("bucket").cogroup(probes.groupBy("bucket")).applyInArrow(
        answer, "grp long, size int, bucket long, levels binary")
    states = asked.where("size = 0").select("grp", "doc_ids", "ths", "held", "state")
    return freeze(states.groupBy("grp").cogroup(answers.groupBy("grp")).applyInArrow(
        meet, f"doc_id {kind}, th long, held_out boolean, codes binary, times binary"))


def scored_levels(found: DataFrame, model) -> DataFrame:
    """(doc_id, th, score) of the rows of ``probed``."""
    def run(batches):
        for b in T.tidied(batches):
            m, score = model.value, []
            for codes, times in zip(b.column("codes"), b.column("times"), strict=True):
                kind, two, one = m.by_levels(codes.as_py())
                p = np.log10(m.weights[kind] * two + (1 - m.weights[kind]) * one)
                score.append(float((p * np.frombuffer(times.as_py(), np.int32)).sum()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), pa.array(score, pa.float64())], names=["doc_id", "th", "score"])

    kind = found.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(run, f"doc_id {kind}, th long, score double")


def fit(training: DataFrame, *, max_entries: int = MAX_ENTRIES, frequent_words: int = FREQUENT_WORDS) -> tuple[Model, DataFrame]:
    """The model of the texts in ``training`` (column text), and the exact word counts (token, c)."""
    counts = freeze(counted_words(training))
    total = counts.agg(F.count("*").alias("v"), F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first()
    # the most frequent words: whole classes of counts, while they fit
    size = F.floor(F.log2("c") * 4)
    classes = sorted(((r["k"], r["n"]) for r in counts.groupBy(size.alias("k")).agg(F.count("*").alias("n")).collect()), reverse=True)  # a few hundred rows
    least, many = None, 0
    for k, n in classes:
        if many + n > frequent_words:
            break
        least, many = k, many + n
    top = counts.where(size >= least).toArrow() if least is not None else None
    frequent = np.asarray(top["token"], np.int64).view(np.uint64) if top is not None else np.empty(0, np.uint64)
    order = np.argsort(frequent)
    known = np.asarray(top["c"], np.int64)[order] if top is not None else np.empty(0, np.int64)
    buckets = max(8, total["n"] // BUCKET_TOKENS)
    ngrams = freeze(counted_ngrams(training, buckets))
    built, segments = build_filter(ngrams, buckets, max_entries)
    model = Model(built, total["n"], total["v"], frequent[order], known, many == total["v"], np.full(KINDS, 0.05), segments)
    return model, counts


def score(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held: int = 1, **kw) -> DataFrame:
    """(doc_id, th, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs``.

    Trained on the rows whose crc32 of the id as text, modulo ``folds``, is not ``held`` (a null id counts
    as the empty text).  A null text is empty and has the end token only.  Repeated rows count, and are
    scored, as often as they occur.  Without training texts every count is 0."""
    fold = F.coalesce(F.crc32(F.col(id_col).cast("string")), F.lit(0)) % folds
    d = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"), (fold == held).alias("held_out"))
    training = d.where(~F.col("held_out")).select("text")
    model, counts = fit(training, **kw)
    sc = docs.sparkSession.sparkContext
    apart = probed(d, model) if model.segments is not None else None
    model.weights = tuned_weights(training if apart is None else apart.where("not held_out").select("codes", "times"), model.sent(sc))
    sent = model.sent(sc)
    here_too = apart is None  # whether the filter is at hand where texts are

    def run(batches):
        for b in T.tidied(batches):
            m = sent.value
            for texts in _groups(_documents(b)):
                if here_too:
                    word, index, kind, two, one = m.estimates([t for _, t in texts])
                    p = np.log10(m.weights[kind] * two + (1 - m.weights[kind]) * one)
                else:
                    word, index = np.unique(np.concatenate([t for _, t in texts]), return_inverse=True)
                    p = np.zeros(len(index))
                c = m.exact(word)
                start = np.cumsum([0, *[len(t) for _, t in texts]])
                here = c[index] >= 0
                base = np.where(here, m.base(np.maximum(c[index], 0)), 0.0)
                rows = pa.array([r for r, _ in texts])
                n = np.diff(start)
                yield _batch(b, rows, n, np.add.reduceat((c[index] > 0).astype(np.int64), start[:-1]), np.add.reduceat(base, start[:-1]),
                             np.add.reduceat(p, start[:-1]), None, None)
                if not here.all():
                    owner = np.repeat(np.arange(len(texts)), n)[~here]
                    key, many = np.unique(owner * len(word) + index[~here], return_counts=True)
                    yield _batch(b, rows.take(pa.array(key // len(word))), None, None, None, None, word[key % len(word)], many)

    def _batch(b, rows, n, known, base, p, token, times):
        k = len(rows)
        col = lambda v, t: pa.nulls(k, t) if v is None else pa.array(v, t)
        return pa.RecordBatch.from_arrays(
            [b.column(c).take(rows) for c in ("doc_id", "th", "held_out")]
            + [col(n, pa.int64()), col(known, pa.int64()), col(base, pa.float64()), col(p, pa.float64()),
               col(None if token is None else token.view(np.int64), pa.int64()), col(times, pa.int64())], names=names)

    names = ["doc_id", "th", "held_out", "n_tokens", "n_known", "base", "score", "token", "times"]
    kind = docs.schema[id_col].dataType.simpleString()
    found = d.mapInArrow(run, f"doc_id {kind}, th long, held_out boolean, n_tokens long, n_known long, base double, score double, token long, times long")
    if not model.complete:
        found = freeze(found)
    out = found.where("token is null").drop("token", "times")
    if not model.complete:
        # a repeated row has repeated tokens; each row of it gets one share
        key = F.xxhash64("doc_id", "th")
        rest = found.where("token is not null").select(key.alias("k"), "token", "times").join(counts, "token", "left")
        c, times = F.coalesce("c", F.lit(0)), F.col("times")
        value = F.log10((c + 0.5) / (model.tokens + 0.5 * (model.words + 1)))
        rest = rest.groupBy("k").agg(F.sum(times * value).alias("b2"), F.sum(F.when(c > 0, times).otherwise(0)).alias("k2"))
        repeats = out.groupBy(key.alias("k")).agg(F.count("*").alias("rows"))
        rest = rest.join(repeats, "k").select("k", (F.col("b2") / F.col("rows")).alias("b2"), F.floor(F.col("k2") / F.col("rows")).alias("k2"))
        out = out.withColumn("k", key).join(rest, "k", "left")
        out = out.withColumns({"base": F.col("base") + F.coalesce("b2", F.lit(0.0)), "n_known": F.col("n_known") + F.coalesce("k2", F.lit(0))})
    if apart is not None:  # repeated rows have one score
        key = F.xxhash64("doc_id", "th")
        scores = scored_levels(apart, sent).groupBy(key.alias("k")).agg(F.max("score").alias("score"))
        out = out.drop("score").withColumn("k", key).join(scores, "k")
    return out.select("doc_id", "th", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
                      F.col("base").alias("base_score"), "score")
