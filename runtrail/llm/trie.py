"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

Turns are ordered within their conversation over range slices, so that a conversation with most
rows spreads over many tasks; texts stay where they are, only their MD5 and length move. The key
of a prefix is the XOR of 64-bit hashes of its turns, each salted with its place, twice over: 128
bits that add up slice by slice. Equal keys are one node of the trie.

Subtree totals need no walk by depth. Every round rakes the leaves (a leaf's total goes to its
parent) and compresses unary chains: a node with one child, whose random rank is above those of its
parent and its child, is spliced out, and what it carries goes to the edge below it. A round is two
exchanges by node key in which a node's row meets the messages of its children. Each round leaves a
fixed share of the nodes, so a chain of n turns takes some log n rounds. The rounds are then undone
last first: a spliced node's total is what it carried plus the total of its child. Every round is
written, so a lost executor costs one round's work.

The ids that end at a node are joined in sorted chunks by many tasks; only the hash over the
chunks of one node is one task's work, as a digest asks for, and is taken chunk by chunk.

Defined results: rows without a conversation id belong to no conversation; a null role or text is
empty; a null turn comes first; turns that tie are ordered by the MD5 of role and text, so repeated
rows are turns of their own in any order; an empty table has no node, not even a root. Very long
texts and conversations are read whole. Further columns are never read, so none clashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runtrail.llm.common import written

KEY = ("k1", "k2")
#: Ids joined to one text ahead of the digest.
CHUNK_IDS = 4096


def ordered_turns(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Every turn with ``conv``, ``place`` (from 1), ``slice``, ``mark`` (MD5 of role and text) and
    ``chars``. Slices of a conversation follow one another.
    """
    role = F.coalesce(conversations[role_col], F.lit(""))
    text = F.coalesce(conversations[text_col], F.lit(""))
    # The length keeps role and text apart.
    mark = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    turns = conversations.select(
        conversations[id_col].cast("long").alias("conv"), conversations[turn_col].alias("turn"),
        mark.alias("mark"), F.length(text).cast("long").alias("chars"),
    ).where("conv IS NOT NULL").withColumn("row", F.monotonically_increasing_id())
    order = [F.col("turn").asc_nulls_first(), F.col("mark"), F.col("row")]
    sliced = written(
        turns.repartitionByRange("conv", *order).withColumn("slice", F.spark_partition_id()), "trie-turns"
    )
    counts = sliced.groupBy("conv", "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("conv", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    nth = F.row_number().over(Window.partitionBy("conv", "slice").orderBy(*order))
    placed = sliced.withColumn("nth", nth).join(starts, ["conv", "slice"])
    return placed.select("conv", "slice", (F.col("nth") + F.col("start")).alias("place"), "mark", "chars")


def rebuilt_turns(turns: DataFrame, base: Column, head: Column, most_head: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns come from a base conversation.

    ``base`` and ``head`` are expressions over ``conv``: the first ``head`` turns (``most_head`` at
    most) are the original ones of ``base``, then come the conversation's own after its first
    ``head``. Returns the turns, with ``last`` on each conversation's final one, and the
    conversations with their ``length``.
    """
    own = turns.groupBy("conv").agg(F.count("*").alias("n")).select(
        "conv", "n", base.alias("base"), head.cast("long").alias("head")
    )
    of_base = own.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    taken = F.least("head", F.coalesce("n_base", F.lit(0)))
    convs = written(own.join(of_base, "base", "left").select(
        "conv", "base", "head", taken.alias("taken"),
        (taken + F.greatest(F.col("n") - F.col("head"), F.lit(0))).alias("length"),
    ), "trie-conversations")
    first = turns.where(F.col("place") <= most_head).select(
        F.col("conv").alias("base"), F.col("place").alias("depth"), "mark", "chars"
    )
    heads = convs.join(first, "base").where("depth <= taken").select(
        "conv", F.lit(-1).alias("slice"), "depth", "mark", "chars", (F.col("depth") == F.col("length")).alias("last")
    )
    rest = turns.join(convs, "conv").where("place > head").withColumn(
        "depth", F.col("taken") + F.col("place") - F.col("head")
    ).select("conv", "slice", "depth", "mark", "chars", (F.col("depth") == F.col("length")).alias("last"))
    return heads.unionByName(rest), convs.select("conv", "length")


def prefix_keys(turns: DataFrame) -> DataFrame:
    """The turns with the key of the prefix that ends at each, and that of the prefix before it."""
    salted = turns.withColumns({"s1": F.xxhash64("depth", "mark"), "s2": F.xxhash64("mark", "depth")})
    before = Window.partitionBy("conv").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = salted.groupBy("conv", "slice").agg(F.bit_xor("s1").alias("x1"), F.bit_xor("s2").alias("x2"))
    starts = sums.select(
        "conv", "slice", *[F.coalesce(F.bit_xor(f"x{i}").over(before), F.lit(0)).alias(f"o{i}") for i in (1, 2)]
    )
    upto = Window.partitionBy("conv", "slice").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    summed = salted.withColumns({f"r{i}": F.bit_xor(f"s{i}").over(upto) for i in (1, 2)})
    keyed = summed.join(starts, ["conv", "slice"]).withColumns(
        {f"k{i}": F.col(f"r{i}").bitwiseXOR(F.col(f"o{i}")) for i in (1, 2)}
    )
    return keyed.select(
        "conv", "depth", "chars", "last", *KEY,
        *[F.col(f"k{i}").bitwiseXOR(F.col(f"s{i}")).alias(f"p{i}") for i in (1, 2)],
    )


def trie_nodes(keyed: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per distinct prefix, the textless root included: its key and its parent's (null for
    the root), smallest member, members, children, and code points of its last text.
    """
    members = [F.min("conv").alias("conv"), F.count("*").alias("n_convs")]
    inner = keyed.groupBy("depth", *KEY, "p1", "p2").agg(*members, F.min("chars").alias("chars"))
    none = F.lit(None).cast("long")
    root = convs.agg(*members).where("n_convs > 0").select(
        F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"),
        none.alias("p1"), none.alias("p2"), "conv", "n_convs", F.lit(0).cast("long").alias("chars"),
    )
    nodes = written(inner.unionByName(root), "trie-nodes")
    children = nodes.where("p1 IS NOT NULL").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count("*").alias("n_children")
    )
    return written(
        nodes.join(children, list(KEY), "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-children"
    )


def _rank(number: int, first: str, second: str) -> Column:
    return F.xxhash64(F.lit(number), first, second)


def _spliced(state: DataFrame, totals: list[str]) -> DataFrame:
    """The live rows of a round once its spliced nodes are gone: each one's child takes its parent
    and, on its edge, what it carried.
    """
    gone = F.col("kind") == "spliced"
    rows = state.where("kind <> 'raked'").select(
        *[F.when(gone, F.col(c)).otherwise(F.col(k)).alias(k) for k, c in zip(KEY, ("c1", "c2"))],
        *[F.when(gone, F.col(p)).alias(f"new_{p}") for p in ("p1", "p2")],
        *[F.when(~gone, F.col(p)).alias(p) for p in ("p1", "p2")],
        F.when(~gone, F.col("k")).alias("k"),
        *[F.when(~gone, F.col(t)).alias(t) for t in totals],
        *[F.when(gone, F.col(t) + F.col(f"edge_{t}")).otherwise(F.col(f"edge_{t}")).alias(f"edge_{t}") for t in totals],
    )
    return rows.groupBy(*KEY).agg(
        *[F.coalesce(F.max(f"new_{p}"), F.max(p)).alias(p) for p in ("p1", "p2")], F.max("k").alias("k"),
        *[F.sum(c).alias(c) for t in totals for c in (t, f"edge_{t}")],
    )


def _raked(live: DataFrame, totals: list[str], number: int) -> DataFrame:
    """A round's nodes: leaves are raked into their parents, and of those that are then left with
    one child the ones of highest rank are spliced.

    ``k`` counts the live children, ``c1`` and ``c2`` name the only one, ``below_`` has its edge.
    """
    leaf = F.col("k") == 0
    none = F.lit(None).cast("long")
    own = F.struct(
        *[F.col(c) for c in (*KEY, "p1", "p2", "k")], *[F.col(c) for t in totals for c in (t, f"edge_{t}")],
        F.lit(0).cast("long").alias("raked"), none.alias("c1"), none.alias("c2"), *[none.alias(f"below_{t}") for t in totals],
    )
    message = F.struct(
        F.col("p1").alias("k1"), F.col("p2").alias("k2"), none.alias("p1"), none.alias("p2"), none.alias("k"),
        *[c for t in totals for c in (
            F.when(leaf, F.col(t) + F.col(f"edge_{t}")).alias(t), none.alias(f"edge_{t}"))],
        leaf.cast("long").alias("raked"),
        *[F.when(~leaf, F.col(k)).alias(c) for k, c in zip(KEY, ("c1", "c2"))],
        *[F.when(~leaf, F.col(f"edge_{t}")).alias(f"below_{t}") for t in totals],
    )
    # The root has no parent to send to.
    rows = live.select(F.explode(F.filter(F.array(own, message), lambda x: x["k1"].isNotNull())).alias("x")).select("x.*")
    met = rows.groupBy(*KEY).agg(
        *[F.max(c).alias(c) for c in ("p1", "p2", "c1", "c2")], F.max("k").alias("had"), F.sum("raked").alias("raked"),
        *[F.sum(c).alias(c) for t in totals for c in (t, f"edge_{t}")], *[F.max(f"below_{t}").alias(f"below_{t}") for t in totals],
    ).withColumn("k", F.col("had") - F.col("raked"))
    rank = _rank(number, *KEY)
    splice = (F.col("k") == 1) & F.col("p1").isNotNull() & (rank > _rank(number, "p1", "p2")) & (rank > _rank(number, "c1", "c2"))
    kind = F.when(F.col("had") == 0, "raked").when(splice, "spliced").otherwise("live")
    return met.withColumn("kind", kind).drop("had", "raked")


def subtree_totals(nodes: DataFrame, totals: list[str]) -> DataFrame:
    """The sums of the named columns over the subtree of every node, by its key.

    ``nodes`` has ``k1``, ``k2``, the parent's ``p1``, ``p2`` (null for a root), ``n_children`` and
    the columns of long numbers.
    """
    live = nodes.select(
        *KEY, "p1", "p2", F.col("n_children").alias("k"), *[F.col(t) for t in totals],
        *[F.lit(0).cast("long").alias(f"edge_{t}") for t in totals],
    )
    rounds = []
    while True:
        rounds.append(state := written(_raked(live, totals, len(rounds)), "trie-round"))
        if state.where("kind <> 'raked'").isEmpty():
            break
        live = _spliced(state, totals)
    known = None
    for state in reversed(rounds):
        found = state.where("kind = 'raked'").select(*KEY, *totals)
        if known is not None:
            spliced = state.where("kind = 'spliced'").select(
                F.col("k1").alias("of1"), F.col("k2").alias("of2"), F.col("c1").alias("k1"), F.col("c2").alias("k2"),
                *[(F.col(t) + F.col(f"below_{t}")).alias(f"above_{t}") for t in totals],
            )
            expanded = spliced.join(known, list(KEY)).select(
                F.col("of1").alias("k1"), F.col("of2").alias("k2"), *[(F.col(t) + F.col(f"above_{t}")).alias(t) for t in totals]
            )
            found = written(found.unionByName(expanded), "trie-totals")
        known = found if known is None else known.unionByName(found)
    return known


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Bounds of the runs of equal rows."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.r_[0, np.flatnonzero(new), n] if n else np.zeros(1, np.int64)


def _numbers(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False) for c in names]


def ends_digests(ends: DataFrame) -> DataFrame:
    """Of each key in ``ends`` the SHA-256 of its ids ``conv``, in numeric order and comma-joined."""

    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2, conv = _numbers(batch, *KEY, "conv")
            bounds = _runs(k1, k2, np.arange(len(conv)) // CHUNK_IDS)
            first = bounds[:-1]
            text = [",".join(map(str, conv[a:b].tolist())) for a, b in zip(first, bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1[first]), pa.array(k2[first]), pa.array(conv[first]), pa.array(text, pa.string())],
                [*KEY, "first", "ids"],
            )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for k1, k2, ids in zip(*[batch.column(c).to_pylist() for c in (*KEY, "ids")]):
                if (k1, k2) != key:
                    if key:
                        done.append((*key, state.hexdigest()))
                    key, state = (k1, k2), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield _digest_batch(done)
        if key:
            yield _digest_batch([(*key, state.hexdigest())])

    chunks = ends.select(*KEY, "conv").repartitionByRange(*KEY, "conv").sortWithinPartitions(*KEY, "conv")
    chunks = chunks.mapInArrow(chunk, "k1 long, k2 long, first long, ids string")
    in_order = chunks.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return in_order.mapInArrow(digest, "k1 long, k2 long, ends_sha256 string")


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 3
    types = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [*KEY, "ends_sha256"])


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The trie of conversations given by ``turns`` (``conv``, ``slice``, ``depth``, ``mark``,
    ``chars``, ``last``) and ``convs`` (``conv``, ``length``). Per node: ``conv_id`` (smallest
    member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``.
    """
    keyed = written(prefix_keys(turns), "trie-prefixes")
    nodes = trie_nodes(keyed, convs)
    totals = subtree_totals(nodes.withColumns({
        "n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("chars"),
    }), ["n_leaves", "saved_tokens"])
    zero = F.lit(0).cast("long")
    turnless = convs.where("length = 0").select(zero.alias("k1"), zero.alias("k2"), "conv")
    digests = ends_digests(keyed.where("last").select(*KEY, "conv").unionByName(turnless))
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("parent_conv_id"))
    facts = nodes.join(totals, list(KEY)).join(digests, list(KEY), "left")
    # A node with most children is split by the adaptive skew join.
    return facts.join(parents, ["p1", "p2"], "left").select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
