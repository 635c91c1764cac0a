"""Operator 1: token ids in wavelet matrices, one per shard.

Texts are range-partitioned by id; each task encodes its texts in order and cuts the ids into
shards of whole documents, about ``shard_tokens`` ids each.  A shard is one compressed binary
value: header, end positions of the documents, the wavelet matrix.  It is written as a row of a
Parquet table through Spark's committer, so a lost task is simply run again and any store
that Spark reaches will do.

The matrix has one bit-plane per bit of the largest id, most significant first.  Each plane
keeps the stable order of the ids after sorting by the bits above; ``rank`` uses a sampled count
per 512 bits, ``select`` a binary search in these samples.  ``Wavelet`` offers access to a token,
the number of occurrences of an id in a range, and the position of its k-th occurrence.

Encoding: a text is cut at single spaces between other characters, where the byte-level
pre-tokenizer always cuts too, and each distinct piece is encoded once per task.  Texts with
other white space beside a space are encoded whole.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from . import textops as T

MAGIC = b"WVM1"
SAMPLE = 512
SHARD_TOKENS = 1 << 21
#: Distinct pieces a Python worker remembers (about 70 bytes each), and bytes of them; beyond, it starts anew.
PIECES, PIECE_BYTES = 3_000_000, 64_000_000
#: Bytes of text that are looked up together.
CHUNK = 2_000_000
#: A space with white space (or nothing) at its side: such a text is encoded whole.
UNSAFE = r"^ | $|[\pZ\t-\r\x{1c}-\x{1f}\x{85}] | [\pZ\t-\r\x{1c}-\x{1f}\x{85}]"


_NO_SPACE = np.arange(256) != 32


class Pool:
    """An array that grows at its end; ``data`` has at least 8 values to spare."""

    def __init__(self, kind):
        self.data, self.used = np.zeros(1024, kind), 0

    def append(self, values: np.ndarray):
        stop = self.used + len(values)
        if stop + 8 > len(self.data):
            data = np.zeros(stop + stop // 4 + 8, self.data.dtype)
            data[:self.used] = self.data[:self.used]
            self.data = data
        self.data[self.used:stop] = values
        self.used = stop


class Encoder:
    """Token ids of texts, each followed by ``end``; distinct pieces are encoded once.  They are looked up by a
    64-bit hash, and then their bytes are compared, so that pieces with one hash stay apart."""

    def __init__(self, path: str, end: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores already
        from tokenizers import Tokenizer
        self.tokenizer, self.end = Tokenizer.from_file(path), end
        # a byte-level token has one character per byte
        self.n_bytes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, k in self.tokenizer.get_vocab().items():
            self.n_bytes[k] = len(token)
        self.clear()

    def clear(self):
        """Forget all pieces: sorted hashes, the slot of each (the newest pieces in tables of their own), the slots' bytes in
        one pool and their ids in another; pieces with the hash of another one are in a dictionary."""
        self.keys, self.slots = np.empty(0, np.uint64), np.empty(0, np.int32)
        self.new_keys, self.new_slots = np.empty(0, np.uint64), np.empty(0, np.int32)
        self.pool, self.bytes = Pool(np.uint32), Pool(np.uint8)
        self.begin, self.size, self.bytes_at, self.n_own = (Pool(np.int32) for _ in range(4))
        self.others: dict[bytes, int] = {}

    def _find(self, key: np.ndarray) -> np.ndarray:
        """The slot of each hash, -1 for unknown ones."""
        out = np.full(len(key), -1, np.int32)
        for keys, slots in ((self.keys, self.slots), (self.new_keys, self.new_slots)):
            if len(keys):
                at = np.searchsorted(keys, key)
                at[at == len(keys)] = 0
                out = np.where(keys[at] == key, slots[at], out)
        return out

    def _encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each) of pieces.  Those with a space before them are encoded many in
        one text: it is cut there anyhow, and the bytes of the ids tell whose they are."""
        if not pieces:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        joined = [b"".join(pieces[at:at + 4000]).decode() for at in range(0, len(pieces), 4000)]
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)])
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        last = np.searchsorted(np.cumsum(self.n_bytes[ids]), ends) + 1
        return ids, np.diff(last, prepend=0)

    def _add(self, pieces: list[bytes]) -> np.ndarray:
        """The new slots of pieces."""
        spaced = np.array([p[:1] == b" " for p in pieces], bool)
        ids, size = self._encode_pieces([p for p in pieces if p[:1] == b" "])
        alone = [e.ids for e in self.tokenizer.encode_batch_fast([p.decode() for p in pieces if p[:1] != b" "], add_special_tokens=False)]
        ids = np.concatenate([ids, np.array([i for x in alone for i in x], np.uint32)])
        size = np.concatenate([size, np.array([len(x) for x in alone], np.int64)])
        slots = np.empty(len(pieces), np.int32)
        slots[np.concatenate([np.flatnonzero(spaced), np.flatnonzero(~spaced)])] = self.size.used + np.arange(len(pieces))
        self.begin.append(self.pool.used + np.cumsum(size) - size)
        self.pool.append(ids)
        self.size.append(size)
        own = [p.lstrip(b" ") for p in pieces]
        own = [own[k] for k in np.argsort(slots).tolist()]
        n = np.fromiter(map(len, own), np.int64, len(own))
        self.bytes_at.append(self.bytes.used + np.cumsum(n) - n)
        self.n_own.append(n)
        self.bytes.append(np.frombuffer(b"".join(own), np.uint8))
        return slots

    def _learn(self, keys: np.ndarray, pieces: list[bytes]) -> np.ndarray:
        """The slots of new pieces, which are known by ``keys`` from now on."""
        slots = self._add(pieces)
        order = np.argsort(keys)
        at = np.searchsorted(self.new_keys, keys[order])
        self.new_keys, self.new_slots = np.insert(self.new_keys, at, keys[order]), np.insert(self.new_slots, at, slots[order])
        if len(self.new_keys) > 100_000 + len(self.keys) // 4:
            at = np.searchsorted(self.keys, self.new_keys)
            self.keys, self.slots = np.insert(self.keys, at, self.new_keys), np.insert(self.slots, at, self.new_slots)
            self.new_keys, self.new_slots = self.new_keys[:0], self.new_slots[:0]
        return slots

    def _ids(self, raw: np.ndarray, bounds: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids) of stretches of text without white space beside a space; ``fresh`` ones
        start a text, the others follow a space."""
        s, e, h, _ = T.run_hashes(raw, bounds, _NO_SPACE, T.byte_values(), 0)
        owner = np.searchsorted(bounds, s, side="right") - 1
        first = (s == bounds[owner]) & fresh[owner]
        back, key = pd.factorize(np.where(first, ~h, h))
        where = np.empty(len(key), np.int64)
        where[back[::-1]] = np.arange(len(back) - 1, -1, -1)  # where each key comes first
        order = np.argsort(key)  # sorted keys are looked up faster
        rank = np.empty(len(key), np.int64)
        rank[order] = np.arange(len(key))
        key, where, back = key[order], where[order], rank[back]
        if self.size.used > PIECES or self.bytes.used > PIECE_BYTES:
            self.clear()
        slot = self._find(key)
        known = slot >= 0
        if not known.all():
            new = where[~known]
            data = raw.tobytes()
            slot[~known] = self._learn(key[~known], [data[a:z] if f else b" " + data[a:z] for a, z, f in
                                                     zip(s[new].tolist(), e[new].tolist(), first[new].tolist(), strict=True)])
        slot = slot[back]
        other = np.flatnonzero(~T.same_bytes(T.spaced_out(raw), s, e - s, self.bytes.data, self.bytes_at.data[slot], self.n_own.data[slot]))
        if len(other):  # another piece has this hash
            pieces = [(b"" if f else b" ") + raw[a:z].tobytes() for a, z, f in zip(s[other].tolist(), e[other].tolist(), first[other].tolist(), strict=True)]
            new = [p for p in dict.fromkeys(pieces) if p not in self.others]
            if new:
                self.others |= zip(new, self._add(new).tolist(), strict=True)
            slot[other] = [self.others[p] for p in pieces]
        size = self.size.data[slot]
        stop = np.cumsum(size)
        ids = self.pool.data[np.repeat(self.begin.data[slot] - (stop - size), size) + np.arange(int(stop[-1]) if len(stop) else 0)]
        return ids, np.bincount(owner, weights=size, minlength=len(fresh)).astype(np.int64)

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each text), end ids included."""
        given = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        whole = pc.match_substring_regex(given, UNSAFE)
        rest = pc.if_else(whole, "", given)
        data, off = T.text_bytes(rest)
        # stretches: texts, long ones cut at spaces
        cuts, owner = [off], [np.arange(len(texts))]
        for k in np.flatnonzero(np.diff(off) > CHUNK).tolist():
            spaces = off[k] + np.flatnonzero(data[off[k]:off[k + 1]] == 32)
            at = np.unique(spaces[np.searchsorted(spaces, np.arange(off[k] + CHUNK, off[k + 1], CHUNK)).clip(max=len(spaces) - 1)]) if len(spaces) else spaces
            cuts.append(at)
            owner.append(np.full(len(at), k))
        begin = np.concatenate([off[:-1], *cuts[1:]])
        owner = np.concatenate(owner)
        order = np.lexsort((begin, owner))
        begin, owner = begin[order], owner[order]
        stop = np.append(begin[1:], off[-1])
        fresh = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(owner) else np.empty(0, bool)
        parts, counts, i = [], [], 0
        while i < len(begin):
            j = max(i + 1, int(np.searchsorted(stop, begin[i] + CHUNK, side="right")))
            ids, n = self._ids(data[begin[i]:stop[j - 1]], np.append(begin[i:j], stop[j - 1]) - begin[i], fresh[i:j])
            parts.append(ids)
            counts.append(n)
            i = j
        ids = np.concatenate(parts) if parts else np.empty(0, np.uint32)
        n = np.bincount(owner, weights=np.concatenate(counts), minlength=len(texts)).astype(np.int64) if counts else np.zeros(len(texts), np.int64)
        for k in np.flatnonzero(np.asarray(whole)).tolist():
            own = np.array(self.tokenizer.encode(given[k].as_py(), add_special_tokens=False).ids, np.uint32)
            ids = np.insert(ids, n[:k].sum(), own)
            n[k] = len(own)
        return np.insert(ids, np.cumsum(n), self.end), n + 1


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder_for(path: str, end: int) -> Encoder:
    """One encoder per Python worker: its pieces serve all tasks that the worker runs."""
    if (path, end) not in _ENCODERS:
        _ENCODERS[path, end] = Encoder(path, end)
    return _ENCODERS[path, end]


class Wavelet:
    """A wavelet matrix over non-negative integers."""

    def __init__(self, n: int, planes: list[np.ndarray]):
        self.n, self.planes = n, planes  # packed bits, padded to whole samples
        self.samples = [np.concatenate([[0], np.cumsum(np.bitwise_count(p.reshape(-1, SAMPLE // 8)).sum(axis=1, dtype=np.int64))])
                        for p in planes]
        self.zeros = [n - int(s[-1]) for s in self.samples]

    @classmethod
    def build(cls, ids: np.ndarray) -> Wavelet:
        n, planes = len(ids), []
        ids = ids.astype(np.uint16) if ids.max(initial=0) < 1 << 16 else ids
        for level in range(max(1, int(ids.max(initial=0)).bit_length()) - 1, -1, -1):
            bit = (ids >> ids.dtype.type(level)).astype(np.uint8) & 1
            planes.append(np.packbits(np.concatenate([bit, np.zeros(-n % SAMPLE, np.uint8)]), bitorder="little"))
            one = bit.view(bool)  # taking by position is several times as fast as selecting by a mask
            ids = np.concatenate([ids.take(np.flatnonzero(~one)), ids.take(np.flatnonzero(one))])
        return cls(n, planes)

    def decode(self) -> np.ndarray:
        """All ids, from the last plane back to the first."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        ids = np.zeros(self.n, kind)
        for depth in range(len(self.planes) - 1, -1, -1):
            bit = np.unpackbits(self.planes[depth], bitorder="little")[:self.n]
            one = bit.view(bool)
            before = np.empty_like(ids)
            before[np.flatnonzero(~one)] = ids[:self.zeros[depth]]
            before[np.flatnonzero(one)] = ids[self.zeros[depth]:]
            ids = before | (bit.astype(kind) << kind(len(self.planes) - 1 - depth))
        return ids.astype(np.uint32)

    def rank1(self, depth: int, i: int) -> int:
        """Ones before position i of a plane."""
        block, rest = divmod(i, SAMPLE)
        bits = np.unpackbits(self.planes[depth][block * SAMPLE // 8:block * SAMPLE // 8 + (rest + 7) // 8], bitorder="little")[:rest]
        return int(self.samples[depth][block]) + int(bits.sum())

    def select(self, depth: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) bit of this kind in a plane."""
        s = self.samples[depth]
        have = s if bit else np.arange(len(s)) * SAMPLE - s
        block = int(np.searchsorted(have, k, side="right")) - 1
        bits = np.unpackbits(self.planes[depth][block * SAMPLE // 8:(block + 1) * SAMPLE // 8], bitorder="little")
        return block * SAMPLE + int(np.flatnonzero(bits == bit)[k - int(have[block])])

    def access(self, i: int) -> int:
        value = 0
        for depth in range(len(self.planes)):
            ones = self.rank1(depth, i)
            bit = self.rank1(depth, i + 1) - ones
            value = value << 1 | bit
            i = self.zeros[depth] + ones if bit else i - ones
        return value

    def _range(self, value: int, lo: int, hi: int) -> tuple[int, int]:
        if value >> len(self.planes):
            return 0, 0
        for depth in range(len(self.planes)):
            a, b = self.rank1(depth, lo), self.rank1(depth, hi)
            if value >> (len(self.planes) - 1 - depth) & 1:
                lo, hi = self.zeros[depth] + a, self.zeros[depth] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, value: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of an id in positions lo..hi-1."""
        a, b = self._range(value, lo, self.n if hi is None else hi)
        return b - a

    def locate(self, value: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of an id; -1 if there are fewer."""
        a, b = self._range(value, 0, self.n)
        if not 0 <= k < b - a:
            return -1
        at = a + k
        for depth in range(len(self.planes) - 1, -1, -1):
            bit = value >> (len(self.planes) - 1 - depth) & 1
            at = self.select(depth, bit, at - self.zeros[depth] * bit)
        return at


def to_bytes(w: Wavelet, ends: np.ndarray) -> bytes:
    body = ends.astype("<i8").tobytes() + b"".join(p.tobytes() for p in w.planes)
    return MAGIC + struct.pack("<qqi", w.n, len(ends), len(w.planes)) + zstandard.ZstdCompressor(level=1).compress(body)


def from_bytes(raw: bytes) -> tuple[Wavelet, np.ndarray]:
    """(matrix, end position of each document) of one shard."""
    assert raw[:4] == MAGIC, "not a wavelet shard"
    n, docs, depth = struct.unpack_from("<qqi", raw, 4)
    body = zstandard.ZstdDecompressor().decompress(raw[24:])
    ends = np.frombuffer(body, "<i8", docs)
    size = -(-n // SAMPLE) * SAMPLE // 8
    planes = [np.frombuffer(body, np.uint8, size, 8 * docs + k * size) for k in range(depth)]
    return Wavelet(n, planes), ends


def write_shards(docs: DataFrame, out: str, *, tokenizer_path: str, end: int = 2, id_col: str = "doc_id", text_col: str = "text",
                 shard_tokens: int = SHARD_TOKENS, partitions: int | None = None) -> None:
    """Write the shards of ``docs`` as Parquet rows (part, shard, doc_ids, n_tokens, blob) to ``out``.

    Documents go in ascending id order, null ids first; rows with one id follow by text hash.  A null
    text is empty and has the end id only."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # split points are sampled by the driver: ids and hashes, never texts
    d = d.withColumn("th", F.xxhash64("text")).repartitionByRange(parts, "doc_id", "th").sortWithinPartitions("doc_id", "th")
    d = d.select("doc_id", "text", F.spark_partition_id().alias("part"))

    def run(batches):
        encoder, shard = encoder_for(tokenizer_path, end), 0
        docs_in, lengths, tokens, held = [], [], [], 0

        def flush():
            nonlocal shard, docs_in, lengths, tokens, held
            n = np.concatenate(lengths)
            blob = to_bytes(Wavelet.build(np.concatenate(tokens)), np.cumsum(n))
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int64()), pa.array([pa.concat_arrays(docs_in).to_pylist()], pa.list_(docs_in[0].type)),
                 pa.array([int(n.sum())], pa.int64()), pa.array([blob], pa.binary())], names=["part", "shard", "doc_ids", "n_tokens", "blob"])
            shard, docs_in, lengths, tokens, held = shard + 1, [], [], [], 0
            return row

        for b in T.tidied(batches):
            part = b.column("part")[0].as_py() if b.num_rows else 0
            sizes = np.asarray(pc.binary_length(b.column("text")), np.int64)
            group = np.cumsum(sizes) // 8_000_000  # texts of about 8 MB at a time
            for g in np.unique(group):
                at = np.flatnonzero(group == g)
                piece = b.slice(at[0], len(at))
                ids, n = encoder.encode(piece.column("text"))
                docs_in.append(piece.column("doc_id"))
                lengths.append(n)
                tokens.append(ids)
                held += len(ids)
                if held >= shard_tokens:
                    yield flush()
        if docs_in:
            yield flush()

    rows = d.mapInArrow(run, f"part int, shard long, doc_ids array<{kind.simpleString()}>, n_tokens long, blob binary")
    rows.write.mode("errorifexists").parquet(out)


def read_documents(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, decoded from the shards at ``path``."""
    shards = spark.read.parquet(path)
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches):
        for b in T.tidied(batches):
            for part, shard, doc_ids, blob in zip(*[b.column(c) for c in ("part", "shard", "doc_ids", "blob")], strict=True):
                w, ends = from_bytes(blob.as_py())
                ids = w.decode().astype("<u4")
                begin = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
                crc = [zlib.crc32(ids[a:z].data) for a, z in zip(begin, ends, strict=True)]
                k = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.as_py()] * k, pa.int32()), pa.array([shard.as_py()] * k, pa.int64()), doc_ids.values, pa.array(begin, pa.int64()),
                     pa.array(ends - begin, pa.int64()), pa.array(crc, pa.int64())], names=["part", "shard", "doc_id", "at", "n_tokens", "ids_crc32"])

    found = shards.select("part", "shard", "doc_ids", "blob").mapInArrow(
        run, f"part int, shard long, doc_id {kind}, at long, n_tokens long, ids_crc32 long")
    # running totals in two levels: over the parts, and over the shards of a part
    size = shards.select(F.col("part").alias("p"), F.col("shard").alias("s"), "n_tokens")
    parts = size.groupBy("p").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select(F.col("p").alias("q"), (F.sum("n").over(Window.orderBy("p")) - F.col("n")).alias("before"))
    size = size.withColumn("inside", F.sum("n_tokens").over(Window.partitionBy("p").orderBy("s")) - F.col("n_tokens"))
    size = size.join(parts, size["p"] == parts["q"]).select("p", "s", (F.col("before") + F.col("inside")).alias("base"))
    j = found.join(size, (found["part"] == size["p"]) & (found["shard"] == size["s"]))
    return j.select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, *, tokenizer_path: str, out: str | None = None, **kw) -> DataFrame:
    """Write the shards (to a new folder beside the checkpoints unless ``out`` is given) and read them back."""
    spark = docs.sparkSession
    out = out or f"{checkpoint_dir(spark)}/wavelet-{uuid.uuid4()}"
    write_shards(docs, out, tokenizer_path=tokenizer_path, **kw)
    return read_documents(spark, out)
