"""Operator 12: packing into windows by non-negative least squares.

Documents are cut into full windows and a rest.  The rests of a shard make a histogram of lengths;
every combination of at most ``DEPTH`` of its lengths that fills a window is a column of a matrix, and
the numbers of repeats that explain the histogram best, in the sense of least squares with no
number below zero, say how often each combination is used.  The numbers are rounded so that
no length is used more often than it occurs.  What they leave over is packed greedily into the tightest window;
then the emptiest of those windows are dealt out to fill the gaps of the others, which cuts documents.  At most
one window of a shard stays open; it becomes windows of a power of two.

A shard is a run of about ``SHARD_TOKENS`` tokens of one Spark partition, in the order of the scan.  Texts are
tokenised, packed and handed out by one task: nothing is shuffled or stored, and a lost task does the same again.
Shards grow in number only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .wavelet import encoder_for

WINDOW, DEPTH = 1024, 3
#: Tokens, and documents, after which a shard is packed.
SHARD_TOKENS, SHARD_DOCS = 1 << 23, 1 << 16
#: Bytes of text that are tokenised together.
TEXT_BYTES = 8_000_000
#: Rounds of the solver at most; it ends before when a round moves no repeat count by this much.
ROUNDS, STILL = 200, 1e-3


def combinations(window: int, depth: int, present: np.ndarray) -> np.ndarray:
    """Rising combinations of up to ``depth`` lengths with ``present[length]`` that add up to
    ``window``, one a row, filled with zeros at the left."""
    lengths = np.flatnonzero(present[:window + 1])
    lengths = lengths[lengths > 0]
    out = []
    for size in range(1, depth + 1):
        rows = np.zeros((1, 0), np.int64)
        for left in range(size - 1, -1, -1):  # parts that follow, none smaller than this one
            rest = window - rows.sum(axis=1)
            low = np.searchsorted(lengths, rows[:, -1] if rows.shape[1] else 1)
            high = np.searchsorted(lengths, rest // (left + 1), side="right")
            low = np.searchsorted(lengths, rest) if not left else low
            many = np.maximum(high - low, 0)
            pick = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            rows = np.column_stack([np.repeat(rows, many, axis=0), lengths[pick]])
        out.append(np.column_stack([np.zeros((len(rows), depth - size), np.int64), rows]))
    return np.concatenate(out)


def repeats(shapes: np.ndarray, histogram: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Numbers >= 0, one for each shape, for which the lengths used come closest to the histogram; a
    length's error counts by the tokens it stands for.  Accelerated projected gradients; the
    matrix has ``depth`` entries a column and is never written out."""
    if not len(shapes):
        return np.zeros(0)
    weight = np.arange(len(histogram)) / (len(histogram) - 1)
    weight = weight * weight
    used = lambda x: np.bincount(shapes.ravel(), np.repeat(x, shapes.shape[1]), len(histogram))
    slope = lambda r: (weight * r)[shapes].sum(axis=1)
    v = np.ones(len(shapes))
    for _ in range(12):  # greatest curvature
        v = slope(used(v))
        curve = np.linalg.norm(v)
        v /= curve
    step = 1 / (1.05 * curve)
    x = ahead = np.zeros(len(shapes))
    pace = 1.0
    for _ in range(rounds):
        new = np.maximum(ahead - step * slope(used(ahead) - histogram), 0)
        if ((new - x) * (ahead - new)).sum() > 0:  # the momentum points uphill
            pace = 1.0
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead, moved = new + (pace - 1) / faster * (new - x), np.abs(new - x).max()
        x, pace = new, faster
        if moved < STILL:
            break
    return x


def rounded(x: np.ndarray, shapes: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Whole repeat counts: each number rounded down, then, by falling remainder, the shapes once more, and as
    often as the lengths left allow; no length is used more often than it occurs."""
    left, out = histogram.tolist(), np.zeros(len(x), np.int64)
    some = np.flatnonzero(x > 1e-6)
    needs = {k: [(n, row.count(n)) for n in set(row) if n] for k, row in zip(some.tolist(), shapes[some].tolist(), strict=True)}

    def use(k: int, at_most: int):
        n = min(at_most, *(left[part] // need for part, need in needs[k])) if at_most else 0
        if n:
            out[k] += n
            for part, need in needs[k]:
                left[part] -= n * need

    for k in some[np.argsort(-x[some], kind="stable")].tolist():
        use(k, int(x[k]))
    rest = some[np.argsort(-(x[some] - out[some]), kind="stable")].tolist()
    for k in rest:
        use(k, 1)
    for k in rest:
        use(k, sum(left))
    return out


def best_fit(pieces: list[tuple[int, int, int]], window: int) -> list[list[tuple[int, int, int]]]:
    """Bins of pieces (row, start, length): longest first, each into the bin with the least room that is enough."""
    rooms: list[list[int]] = [[] for _ in range(window + 1)]
    bins, mask = [], 0  # bit r of the mask: some bin has room r
    for piece in sorted(pieces, key=lambda p: (-p[2], p[0])):
        size = piece[2]
        above = mask >> size
        if above:
            room = size + (above & -above).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                mask &= ~(1 << room)
            bins[b].append(piece)
        else:
            room, b = window, len(bins)
            bins.append([piece])
        if room > size:
            rooms[room - size].append(b)
            mask |= 1 << (room - size)
    return bins


def filled(bins: list[list[tuple[int, int, int]]], window: int) -> list[list[tuple[int, int, int]]]:
    """The bins with their gaps closed: the emptiest are dealt out to the fullest, pieces cut where the gap ends.
    What one last bin holds is cut into bins of a power of two each."""
    size = lambda b: sum(p[2] for p in b)
    done = [b for b in bins if size(b) == window]
    open_ = sorted((b for b in bins if size(b) < window), key=size, reverse=True)
    i, j = 0, len(open_) - 1
    gap = window - size(open_[0]) if open_ else 0
    while i < j:
        row, start, length = open_[j].pop()
        take = min(gap, length)
        open_[i].append((row, start, take))
        if take < length:
            open_[j].append((row, start + take, length - take))
        gap -= take
        if not gap:
            i += 1
            gap = window - size(open_[i])
        if not open_[j]:
            j -= 1
    done += open_[:i]
    last, held = (open_[i] if open_ and i <= j else []), 0
    n = size(last)
    while n:
        target, own, held = 1 << (n.bit_length() - 1), [], 0
        while held < target:
            row, start, length = last.pop()
            take = min(target - held, length)
            own.append((row, start, take))
            held += take
            if take < length:
                last.append((row, start + take, length - take))
        done.append(own)
        n -= target
    return done


def pack_lengths(lengths: np.ndarray, window: int = WINDOW, depth: int = DEPTH) -> np.ndarray:
    """The pieces of documents of these lengths, as rows (document, start, length, sequence, offset) by
    document and start."""
    full, rest = np.divmod(lengths, window)
    owner = np.repeat(np.arange(len(lengths)), full)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(full) - full, full)
    out = [np.column_stack([owner, number * window, np.full(len(owner), window), np.arange(len(owner)), np.zeros(len(owner), np.int64)])]
    n_seq = len(owner)

    histogram = np.bincount(rest[rest > 0], minlength=window + 1)
    shapes = combinations(window, depth, histogram > 0)
    times = rounded(repeats(shapes, histogram), shapes, histogram)
    some = np.repeat(shapes[times > 0], times[times > 0], axis=0)
    offsets = np.cumsum(some, axis=1) - some
    slot = np.column_stack([some.ravel(), np.repeat(n_seq + np.arange(len(some)), depth), offsets.ravel()])
    slot = slot[slot[:, 0] > 0]
    slot = slot[np.argsort(slot[:, 0], kind="stable")]
    n_seq += len(some)
    order = np.argsort(rest, kind="stable")
    order = order[rest[order] > 0]  # documents by length: the k-th of a length takes its k-th slot
    place = np.arange(len(order)) - np.searchsorted(rest[order], rest[order])
    slots = np.bincount(slot[:, 0], minlength=window + 1)
    packed = place < slots[rest[order]]
    who = order[packed]
    out.append(np.column_stack([who, full[who] * window, rest[who], slot[:, 1], slot[:, 2]]))

    left = order[~packed]
    bins = filled(best_fit([(int(k), int(full[k]) * window, int(rest[k])) for k in left], window), window)
    flat = [(*piece, n_seq + b, at) for b, own in enumerate(bins) for piece, at in
            zip(own, np.cumsum([0, *[p[2] for p in own]]).tolist(), strict=False)]
    out.append(np.array(flat, np.int64).reshape(-1, 5))
    out = np.concatenate(out)
    return out[np.lexsort((out[:, 1], out[:, 0]))]


def pack_windows(docs: DataFrame, *, tokenizer_path: str, end: int = 0, window: int = WINDOW, depth: int = DEPTH, id_col: str = "doc_id",
                 text_col: str = "text", shard_tokens: int = SHARD_TOKENS, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """(doc_id, row, start, length, doc_tokens, sequence_id, offset, ids): the pieces of each document, with their token
    ids as unsigned 32-bit little-endian integers.

    A null text is empty and has the end id only.  Repeated rows are packed each on its own and told apart by ``row``; null
    ids stay null.  Other columns are not read.  An empty table gives no rows."""
    kind = docs.schema[id_col].dataType.simpleString()
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                    F.spark_partition_id().alias("part"))

    def run(batches):
        encoder, part, first, sequences = encoder_for(tokenizer_path, end), 0, 0, 0
        names, sizes, tokens = [], [], []

        def flush():
            nonlocal first, sequences, names, sizes, tokens
            lengths, who = np.concatenate(sizes), pa.concat_arrays(names)
            ids = np.concatenate(tokens).astype("<u4")
            pieces = pack_lengths(lengths, window, depth)
            base = np.cumsum(lengths) - lengths
            # by document and start, the pieces are all ids in order
            ends = np.append(base[pieces[:, 0]] + pieces[:, 1], len(ids)) * 4
            for at in range(0, len(pieces), 10_000):
                p = pieces[at:at + 10_000]
                cut = ends[at:at + len(p) + 1]
                data = pa.py_buffer(ids.view(np.uint8)[cut[0]:cut[-1]].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [who.take(pa.array(p[:, 0])), pa.array((part << 40) + first + p[:, 0]), pa.array(p[:, 1]), pa.array(p[:, 2]),
                     pa.array(lengths[p[:, 0]]), pa.array((part << 40) + sequences + p[:, 3]), pa.array(p[:, 4]),
                     pa.Array.from_buffers(pa.large_binary(), len(p),
                                           [None, pa.py_buffer((cut - cut[0]).astype(np.int64)), data]).cast(pa.binary())],
                    names=["doc_id", "row", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
            first, sequences = first + len(lengths), sequences + int(pieces[:, 3].max()) + 1
            names, sizes, tokens = [], [], []

        held = 0
        for b in T.tidied(batches):
            part = b.column("part")[0].as_py() if b.num_rows else part
            group = np.cumsum(np.asarray(pc.binary_length(b.column("text")), np.int64)) // TEXT_BYTES
            for g in np.unique(group):
                at = np.flatnonzero(group == g)
                some = b.slice(at[0], len(at))
                ids, n = encoder.encode(some.column("text"))
                names.append(some.column("doc_id"))
                sizes.append(n)
                tokens.append(ids)
                held += len(ids)
                if held >= shard_tokens or sum(map(len, sizes)) >= shard_docs:
                    yield from flush()
                    held = 0
        if sizes:
            yield from flush()

    return d.mapInArrow(run, f"doc_id {kind}, row long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def sequences(pieces: DataFrame, *, window: int = WINDOW, pad: int = 0) -> DataFrame:
    """(sequence_id, n_tokens, ids): the sequences that ``pack_windows`` made, filled with ``pad`` up to the window
    unless their length is a power of two."""
    own = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    s = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), own.alias("own"))
    ids = F.aggregate("own", F.lit(b""), lambda got, p: F.concat(got, p["ids"]))
    whole = F.expr("n_tokens & (n_tokens - 1)") == 0
    fill = F.when(whole, F.lit(b"")).otherwise(F.expr(f"unhex(repeat('{pad.to_bytes(4, 'little').hex()}', cast({window} - n_tokens as int)))"))
    return s.select("sequence_id", "n_tokens", F.concat(ids, fill).alias("ids"))
