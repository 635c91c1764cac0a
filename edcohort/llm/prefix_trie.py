"""Operator 13: the prefix trie of conversations, as a burst trie.

A turn is known by the first 128 bits of the SHA-256 of its role and text.  Suffixes of conversations lie in
containers under the heads of the trie.  A container with more than ``CONTAINER`` turns is oversized: it becomes
a head node, and its suffixes go on to containers by their next turn id, until none is oversized.  As a prefix's
turns only get fewer with each turn added, all bursts show in one count of the turns under each prefix: the
prefixes with too many are the heads.

The containers left are dealt into shards by a hash, sorted and swept: one pass over the sorted suffixes keeps the path
of open nodes and hands out each node when the next suffix leaves it.  Heads may stand over any number of
conversations (all that share a first turn), so what they hold is summed by aggregates: every container
and head node is owned by its smallest member, and a head's total is the sum of what is owned below it, along the paths of
the owners.  The ids that end in a head are hashed as a sorted stream of blocks of ids.

No step puts the turns of a long conversation, or the conversations of a common prefix, into one group in memory.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordinal import global_ordinal
from . import textops as T
from .common import bounded, freeze

#: Turns in a container at most; turns of a conversation in one window; neighbouring ids in one block.
CONTAINER, BLOCK, IDS = 2000, 1024, 4096
PREFIX = ["depth", "h1", "h2"]
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def ordered_turns(conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """(conv, pos, turn_id, bytes): the turns of each conversation, numbered from 1 by turn (null first); equal turn
    numbers go by turn id.  A null role or text is empty.  Rows with a null conversation id are of no conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    named = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    t = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), named.substr(1, 32).alias("turn_id"),
        F.octet_length(text).cast("long").alias("bytes"))
    t = global_ordinal(t, order_by=["turn", "turn_id"], partition_by=["conv"], name="pos", start=1)
    return t.select("conv", "pos", F.unhex("turn_id").alias("turn_id"), "bytes")


def with_heads_of(turns: DataFrame, base: Column, heads: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """(turns, members) of rebuilt conversations: each starts with the first ``heads`` (at most ``most``) turns of the
    conversation ``base``, as far as there are, and goes on with its own turns after its first ``heads``.  ``base`` and ``heads`` are
    columns of ``conv``.  The turns are (conv, depth, turn_id, bytes), the members all conversation ids."""
    c = freeze(turns.groupBy("conv").agg(F.max("pos").alias("n")))
    c = c.select("conv", "n", base.alias("base"), heads.alias("heads"))
    of = c.select(F.col("conv").alias("b"), F.col("n").alias("base_n"))
    c = c.join(of, F.col("base") == F.col("b"), "left")
    c = freeze(c.select("conv", "base", "heads", F.least("heads", F.coalesce("base_n", F.lit(0))).alias("shared")))
    key = c.select(F.col("conv").alias("c"), "heads", "shared")
    own = turns.join(key, F.col("conv") == F.col("c")).where(F.col("pos") > F.col("heads"))
    own = own.select("conv", (F.col("pos") - F.col("heads") + F.col("shared")).alias("depth"), "turn_id", "bytes")
    first = turns.where(F.col("pos") <= most).withColumnRenamed("conv", "from")
    first = first.join(c, (F.col("from") == F.col("base")) & (F.col("pos") <= F.col("shared")))
    first = first.select("conv", F.col("pos").alias("depth"), "turn_id", "bytes")
    return own.unionByName(first), c.select("conv")


def running(rows: DataFrame, sums: dict[str, Column], add) -> DataFrame:
    """``rows`` (conv, depth, ...) with the running ``add`` (an aggregate) of each column along each conversation, and its total
    as ``all_<name>``; windows hold a block of turns, and one row per block."""
    r = rows.withColumns({f"_{k}": v for k, v in sums.items()}).withColumn("_block", F.floor((F.col("depth") - 1) / BLOCK))
    inside = Window.partitionBy("conv", "_block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("c").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("c")
    blocks = r.groupBy(F.col("conv").alias("c"), F.col("_block").alias("b")).agg(*[add(f"_{k}").alias(f"t_{k}") for k in sums])
    blocks = blocks.select("c", "b", *[F.coalesce(add(f"t_{k}").over(before), F.lit(0)).alias(f"b_{k}") for k in sums],
                           *[add(f"t_{k}").over(every).alias(f"all_{k}") for k in sums])
    r = r.withColumns({f"_{k}": add(f"_{k}").over(inside) for k in sums})
    r = r.join(blocks, (F.col("conv") == F.col("c")) & (F.col("_block") == F.col("b")))
    both = lambda k: F.col(f"_{k}").bitwiseXOR(F.col(f"b_{k}")) if add is F.bit_xor else F.col(f"_{k}") + F.col(f"b_{k}")
    return r.withColumns({k: both(k) for k in sums}).drop("_block", "c", "b", *[x for k in sums for x in (f"_{k}", f"b_{k}")])


def digest(ids) -> str:
    return hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()


class Sweep:
    """The nodes of sorted suffixes, one container after the other.  The path of open nodes is a stack; a node
    is complete when a suffix comes that does not go through it.  Rows wait in their parent for its smallest id."""

    def __init__(self):
        self.path, self.turns, self.key, self.out, self.tops = [], [], None, [], []

    def add(self, key, depth: int, parent: int, up: tuple, conv: int, suffix: list[tuple], sizes: list[int]):
        """One suffix: turn ids and sizes from ``depth`` on, under the head node ``up`` whose smallest id is ``parent``."""
        if key != self.key:
            self.leave(0)
            self.key, self.depth, self.parent, self.up = key, depth, parent, up
        common = 0
        for a, b in zip(self.turns, suffix, strict=False):
            if a != b:
                break
            common += 1
        self.leave(common)
        for turn, size in zip(suffix[common:], sizes[common:], strict=True):
            self.turns.append(turn)
            self.path.append([size, None, 0, 0, 0, 0, [], []])  # bytes, smallest id, members, children, leaves, saved, ends, rows below
        self.path[-1][6].append(conv)

    def leave(self, keep: int):
        while len(self.path) > keep:
            size, conv, n, children, leaves, saved, ends, below = self.path.pop()
            self.turns.pop()
            conv, n = min(ends, default=conv) if conv is None else min([conv, *ends]), n + len(ends)
            leaves, saved = leaves + (children == 0), saved + (n - 1) * size
            at = self.depth + len(self.path)
            self.out += [(*row, conv) for row in below]
            row = (conv, at, n, children, leaves, saved, digest(ends))
            if self.path:
                up = self.path[-1]
                up[1] = conv if up[1] is None else min(up[1], conv)
                up[2:6] = up[2] + n, up[3] + 1, up[4] + leaves, up[5] + saved
                up[7].append(row)
            else:
                self.out.append((*row, self.parent))
                self.tops.append((len(self.out) - 1, self.up))


def swept(containers: DataFrame) -> DataFrame:
    """The nodes of the containers' suffixes (sorted within partitions), with their heads ``u1``, ``u2`` where they are the first."""
    def run(batches):
        sweep = Sweep()

        def rows():
            n = len(sweep.out)
            cols = list(zip(*sweep.out, strict=True)) if n else [[]] * 8
            up = [(None, None)] * n
            for k, u in sweep.tops:
                up[k] = u
            sweep.out, sweep.tops = [], []
            conv, depth, members, children, leaves, saved, ends, parent = cols
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.string() if c is ends else pa.int64())
                 for c in (conv, depth, parent, members, children, leaves, saved, ends)]
                + [pa.array([u[i] for u in up], pa.int64()) for i in (0, 1)],
                names=["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "u1",
                       "u2"])

        for b in T.tidied(batches):
            r = b.to_pydict()
            for conv, depth, h1, h2, u1, u2, parent, suffix in zip(*[r[c]













































































































































































































































































































































































































                                                                     for c in ("conv", "depth", "h1", "h2", "u1", "u2", "parent", "suffix")], strict=True):
                sweep.add((depth, h1, h2), depth, parent, (u1, u2), conv, [(x["t1"], x["t2"]) for x in suffix], [x["bytes"] for x in suffix])
                if len(sweep.out) > 20_000:
                    yield rows()
        sweep.leave(0)
        yield rows()

    return containers.mapInArrow(run, f"{NODE}, u1 long, u2 long")


def hashed_ends(ends: DataFrame) -> DataFrame:
    """(depth, h1, h2, ends_sha256) of (depth, h1, h2, conv): the hash of the ids of each node in numerical order."""
    blocks = ends.groupBy(*PREFIX, F.floor(F.col("conv") / IDS).alias("block")).agg(F.array_sort(F.collect_list("conv")).alias("ids"))
    blocks = blocks.select(*PREFIX, "block", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))
    blocks = blocks.repartition(*PREFIX).sortWithinPartitions(*PREFIX, "block")

    def run(batches):
        node, state, done = None, None, []

        def flush():
            nonlocal done
            cols = list(zip(*done, strict=True)) or [[]] * 4
            done = []
            return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())], names=[*PREFIX, "ends_sha256"])

        for b in T.tidied(batches):
            for *key, ids in zip(*[b.column(c).to_pylist() for c in (*PREFIX, "ids")], strict=True):
                if key != node:
                    if node:
                        done.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield flush()
        if node:
            done.append((*node, state.hexdigest()))
            yield flush()

    return blocks.mapInArrow(run, "depth long, h1 long, h2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame, members: DataFrame, *, container: int = CONTAINER) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of each node of the trie of
    ``turns`` (conv, depth from 1 without gaps, turn_id, bytes); ``members`` (conv) are all conversations, those without
    turns too.

    A node goes by its smallest member ``conv_id`` and its depth; the root's parent is null.  ``saved_tokens`` is the sum over the subtree of
    (members - 1) * bytes of the last turn.  Without members there is no node."""
    h = lambda seed: F.xxhash64(F.lit(seed), "depth", "turn_id")
    turns = freeze(turns)
    p = turns.withColumns({"t1": h(1), "t2": h(2)})
    p = running(p, {"h1": F.col("t1"), "h2": F.col("t2")}, F.bit_xor)
    last = turns.groupBy(F.col("conv").alias("c")).agg(F.max("depth").alias("last"))
    p = p.join(last, F.col("conv") == F.col("c"))
    up = {"u1": F.col("h1").bitwiseXOR(F.col("t1")), "u2": F.col("h2").bitwiseXOR(F.col("t2"))}
    p = freeze(p.withColumns(up).select("conv", *PREFIX, "u1", "u2", "t1", "t2", "bytes", "last"))

    # heads: prefixes that stand over more turns than a container holds
    heads = p.groupBy(*PREFIX).agg(F.count("*").alias("n_convs"), F.sum(F.col("last") - F.col("depth") + 1).alias("weight"), F.min("conv").alias("conv_id"),
                                   F.min("bytes").alias("bytes"), F.min("u1").alias("u1"), F.min("u2").alias("u2"))
    heads = freeze(heads.where(F.col("weight") > container).drop("weight"))
    n_members, first = members.agg(F.count("*"), F.min("conv")).first()
    if not n_members:
        return turns.sparkSession.createDataFrame([], NODE)
    parent = heads.select(*[F.col(c).alias(f"p_{c}") for c in PREFIX], F.col("conv_id").alias("p_conv"))
    parent = parent.unionByName(turns.sparkSession.createDataFrame([(0, 0, 0, first)], "p_depth long, p_h1 long, p_h2 long, p_conv long"))
    parent = bounded(freeze(parent))
    is_parent = lambda depth, a, b: (F.col("p_depth") == depth) & (F.col("p_h1") == F.col(a)) & (F.col("p_h2") == F.col(b))
    p = p.join(parent, is_parent(F.col("depth"), "h1", "h2"), "left").withColumn("is_head", F.col("p_conv").isNotNull())
    p = p.drop("p_depth", "p_h1", "p_h2")

    # containers: what follows the heads of each conversation
    suffix = F.array_sort(F.collect_list(F.struct("depth", "t1", "t2", "bytes")))
    top = F.min(F.struct(*PREFIX, "u1", "u2")).alias("top")
    rest = p.where(~F.col("is_head")).groupBy("conv").agg(top, suffix.alias("suffix")).select("conv", "top.*", "suffix")
    rest = rest.join(parent, is_parent(F.col("depth") - 1, "u1", "u2")).withColumnRenamed("p_conv", "parent")
    rest = rest.select("conv", *PREFIX, "u1", "u2", "parent", "suffix")
    rest = rest.repartition(*PREFIX).sortWithinPartitions(*PREFIX, F.transform("suffix", lambda s: F.struct(s["t1"], s["t2"])), "conv")
    nodes = freeze(swept(rest))

    # heads: children, and sums of what is owned below
    tops = nodes.where(F.col("u1").isNotNull()).select("conv_id", (F.col("depth") - 1).alias("depth"), "u1", "u2", F.col("n_leaves").alias("leaves"),
                                                       F.col("saved_tokens").alias("saved"))
    edges = tops.select(*[F.col(c).alias(f"e_{c}") for c in ("depth", "u1", "u2")]).unionByName(
        heads.select((F.col("depth") - 1).alias("e_depth"), F.col("u1").alias("e_u1"), F.col("u2").alias("e_u2")))
    edges = edges.groupBy("e_depth", "e_u1", "e_u2").agg(F.count("*").alias("n_children"))
    heads = heads.join(edges, (F.col("depth") == F.col("e_depth")) & (F.col("h1") == F.col("e_u1")) & (F.col("h2") == F.col("e_u2")), "left")
    heads = heads.drop("e_depth", "e_u1", "e_u2").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    heads = freeze(heads)
    own = heads.select("conv_id", "depth", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    items = own.unionByName(tops.drop("u1", "u2")).groupBy(F.col("conv_id").alias("owner"), F.col("depth").alias("at")).agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    items = freeze(items)
    owners = items.select(F.col("owner").alias("o")).distinct()
    path = p.where("is_head").select("conv", *PREFIX).join(owners, F.col("conv") == F.col("o"), "left_semi")
    path = path.join(items, (F.col("conv") == F.col("owner")) & (F.col("depth") == F.col("at")), "left")
    path = path.select("conv", *PREFIX, *[F.coalesce(c, F.lit(0)).alias(f"own_{c}") for c in ("leaves", "saved")])
    path = running(path, {c: F.col(f"own_{c}") for c in ("leaves", "saved")}, F.sum)
    below = path.groupBy(*PREFIX).agg(*[F.sum(F.col(f"all_{c}") - F.col(c) + F.col(f"own_{c}")).alias(n) for c, n in (("leaves", "n_leaves"), ("saved", "saved_tokens"))])

    # ids that end in heads, and conversations without turns
    no_turns = members.join(last, F.col("conv") == F.col("c"), "left_anti")
    zero = [F.lit(0).cast("long").alias(c) for c in PREFIX]
    ends = p.where(F.col("is_head") & (F.col("depth") == F.col("last"))).select(*PREFIX, "conv").unionByName(no_turns.select(*zero, "conv"))
    ends = freeze(hashed_ends(ends))
    total = items.agg(F.coalesce(F.sum("leaves"), F.lit(1)).alias("n_leaves"), F.coalesce(F.sum("saved"), F.lit(0)).alias("saved_tokens"))
    at_root = edges.where("e_depth = 0").agg(F.coalesce(F.sum("n_children"), F.lit(0))).first()[0]
    top = total.withColumn("n_children", F.lit(at_root)).select(*zero, F.lit(n_members).cast("long").alias("n_convs"), F.lit(first).cast("long").alias("conv_id"),
                                                  *[F.lit(None).cast("long").alias(c) for c in ("u1", "u2")], "n_children", "n_leaves", "saved_tokens")
    inner = heads.drop("bytes").join(below, PREFIX).unionByName(top)
    inner = inner.join(ends, PREFIX, "left")
    inner = inner.join(parent, is_parent(F.col("depth") - 1, "u1", "u2"), "left")
    inner = inner.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(digest([])))).withColumnRenamed("p_conv", "parent_conv_id")
    names = [c.split()[0] for c in NODE.split(", ")]
    return nodes.select(*names).unionByName(inner.select(*names))
