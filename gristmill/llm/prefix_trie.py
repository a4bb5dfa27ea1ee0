"""The trie of conversation prefixes, with statistics of every node, by ROLLUP over turn columns.

A conversation is the sequence of its turns, a node a distinct sequence of first turns. `WIDTH` turn
ids stand side by side in a row, and one `GROUP BY block, prefix, ROLLUP (t0, t1, ...)` aggregates all
prefixes of all lengths together; `grouping_id` tells how long each one is. A longer conversation has
a row per block of `WIDTH` turns, and the rows of later blocks are grouped under the node that the
block before ended in. That node's key is known beforehand: the sum of hashes of (place, role, text)
over its turns, 128 bits, kept as four sums of 32 bits so that they cannot overflow.

Sums over subtrees need no walk over the trie. Every node belongs to its smallest member, and the
nodes of one member form a chain from some depth down to its end. A subtree's sum is the sum over its
members' whole chains, which a second ROLLUP gives, less what lies above the node on its own
member's chain. Leaves end chains, so they are counted alike.

No row holds more than `WIDTH` turns, texts are read once and never shuffled (their hash and length
are), and equal conversations are combined before the shuffle. The digest over a node's ending
members is sequential by nature: ids are first joined in pieces of at most `PIECE` ids, then hashed in
one pass over the sorted pieces, in constant memory.

Rows: turns are ordered by turn, nulls first, equal ones by a hash of role and text. A null role or
text counts as empty. Rows without a conversation are in no conversation. Repeated rows are turns of
their own. Without conversations there are no nodes, not even the root. Columns other than the four
named do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.session import cut

WIDTH = 8
# Ending members whose ids are joined to one piece: those that agree but for this many low bits.
PIECE_BITS = 12
LOW = (1 << 32) - 1
KEY = ["depth", "ka", "kb"]


def keyed(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv_id, turn, content (a hash of role and text) and n_bytes (UTF-8 bytes of the text)."""
    who, what = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    whole = F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, what)
    return turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
        F.unhex(F.md5(whole.cast("binary"))).alias("content"), F.octet_length(what).cast("long").alias("n_bytes"),
    )


def in_order(*partition: str) -> Window:
    return Window.partitionBy(*partition).orderBy(F.col("turn").asc_nulls_first(), "content")


def _halves(hashed: Column) -> list[Column]:
    return [F.shiftrightunsigned(hashed, 32), hashed.bitwiseAND(F.lit(LOW))]


def _packed(high: Column, low: Column) -> Column:
    return F.shiftleft(high.bitwiseAND(F.lit(LOW)), 32).bitwiseOR(low.bitwiseAND(F.lit(LOW)))


def blocks(turns: DataFrame, conversations: DataFrame | None = None, width: int = WIDTH) -> DataFrame:
    """A row per conversation and block: conv_id, block, prefix (sums of the turns before the block)
    and the turns t0, t1, ... with nulls after the last one. Conversations that are listed but have
    no turns get one row without any."""
    order = in_order("conv_id")
    rows = turns.withColumn("pos", F.row_number().over(order) - 1)
    hashes = [F.xxhash64(F.lit(k), "pos", "content") for k in (1, 2)]
    parts = [p for h in hashes for p in _halves(h)]
    rows = rows.select("conv_id", "turn", "content", "n_bytes", "pos", *[p.alias(f"h{k}") for k, p in enumerate(parts)])
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    prefix = F.struct(*[F.coalesce(F.sum(f"h{k}").over(before), F.lit(0)).alias(f"h{k}") for k in range(4)])
    rows = rows.select(
        "conv_id", F.expr(f"pos div {width}").alias("block"), (F.col("pos") % width).alias("slot"),
        F.struct("h0", "h1", "h2", "h3", "n_bytes").alias("t"), prefix.alias("prefix"),
    )
    out = rows.groupBy("conv_id", "block").agg(
        F.max(F.when(F.col("slot") == 0, F.col("prefix"))).alias("prefix"),
        *[F.max(F.when(F.col("slot") == k, F.col("t"))).alias(f"t{k}") for k in range(width)],
    )
    if conversations is None:
        return out
    silent = conversations.select("conv_id").where("conv_id IS NOT NULL").distinct()
    silent = silent.join(turns.select("conv_id").distinct(), "conv_id", "left_anti")
    fields = {f.name: f.dataType for f in out.schema.fields}
    nothing = F.struct(*[F.lit(0).cast("long").alias(f"h{k}") for k in range(4)])
    return out.unionByName(
        silent.select(
            "conv_id", F.lit(0).cast(fields["block"]).alias("block"), nothing.alias("prefix"),
            *[F.lit(None).cast(fields[f"t{k}"]).alias(f"t{k}") for k in range(width)],
        )
    )


def _keys(width: int, last: Column | None = None) -> list[Column]:
    """The two halves of a row's node key, from its prefix and turns; without `last` if given."""
    sums = []
    for k in range(4):
        total = F.col(f"prefix.h{k}")
        for j in range(width):
            total = total + F.coalesce(F.col(f"t{j}.h{k}"), F.lit(0))
        sums.append(total if last is None else total - F.coalesce(last[f"h{k}"], F.lit(0)))
    return [_packed(sums[0], sums[1]), _packed(sums[2], sums[3])]


def rolled_up(rows: DataFrame, aggregates: str, width: int = WIDTH) -> DataFrame:
    """`aggregates` of every node: depth, ka, kb, the parent's pa and pb, n_bytes of the last turn."""
    turns = ", ".join(f"t{k}" for k in range(width))
    every = rows.sparkSession.sql(
        f"SELECT block, prefix, {turns}, {width} - bit_count(grouping_id()) AS level, {aggregates} "
        f"FROM {{rows}} GROUP BY block, prefix, ROLLUP ({turns})",
        rows=rows,
    )
    last = F.coalesce(*[F.col(f"t{k}") for k in reversed(range(width))])
    # shorter conversations have null turns of their own: those groups are no nodes; and the top of
    # a later block is the node that the block before has ended in
    filled = sum([F.col(f"t{k}").isNotNull().cast("int") for k in range(width)], F.lit(0))
    real = (filled == F.col("level")) & ((F.col("level") > 0) | (F.col("block") == 0))
    node, parent = _keys(width), _keys(width, last)
    named = [c for c in every.columns if c not in {"block", "prefix", "level", *[f"t{k}" for k in range(width)]}]
    return every.where(real).select(
        (F.col("block") * width + F.col("level")).cast("long").alias("depth"),
        node[0].alias("ka"), node[1].alias("kb"), parent[0].alias("pa"), parent[1].alias("pb"),
        F.coalesce(last["n_bytes"], F.lit(0)).alias("n_bytes"), *named,
    )


def ending_digests(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """depth, ka, kb and ends_sha256 of the nodes in which conversations end."""
    filled = sum([F.col(f"t{k}").isNotNull().cast("int") for k in range(width)], F.lit(0))
    ka, kb = _keys(width)
    ends = rows.select(
        "conv_id", (F.col("block") * width + filled).cast("long").alias("depth"), ka.alias("ka"), kb.alias("kb")
    )
    ends = ends.groupBy("conv_id").agg(F.max(F.struct(*KEY)).alias("end"))
    pieces = ends.groupBy("end", F.shiftright("conv_id", PIECE_BITS).alias("piece")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )
    pieces = pieces.select("end.*", "piece", "ids").repartition(*KEY).sortWithinPartitions(*KEY, "piece")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for *at, _, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if at != key:
                    if state is not None:
                        done.append([*key, state.hexdigest()])
                    key, state = at, hashlib.sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
            yield packed(done)
        if state is not None:
            yield packed([[*key, state.hexdigest()]])

    def packed(found: list[list]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        columns = zip(*found, strict=True) if found else [[]] * 4
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=[*KEY, "ends_sha256"])

    return pieces.mapInArrow(digest, "depth long, ka long, kb long, ends_sha256 string")


def build(turns: DataFrame, conversations: DataFrame | None = None, width: int = WIDTH) -> DataFrame:
    """The nodes of the trie of `turns` (as `keyed` gives them) and of the turnless among
    `conversations` (conv_id): conv_id (smallest member), depth, parent_conv_id, n_convs (members),
    n_children, n_leaves (childless nodes of its subtree), saved_tokens (over its subtree, each
    node's members but one times the bytes of its last text), ends_sha256 (of the sorted ids of
    the members that end here, joined by commas)."""
    rows = cut(blocks(turns, conversations, width), "trie-blocks")
    nodes = cut(rolled_up(rows, "count(*) AS n_convs, min(conv_id) AS conv_id", width), "trie-nodes")
    inner = nodes.where("depth > 0")
    children = inner.groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("ka"), F.col("pb").alias("kb"))
    children = children.agg(F.count("*").alias("n_children"))
    owners = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("ka").alias("pa"), F.col("kb").alias("pb"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    saved = (F.col("n_convs") - 1) * F.col("n_bytes")
    known = nodes.join(children, KEY, "left").join(owners, ["depth", "pa", "pb"], "left")
    known = known.select(
        *KEY, "conv_id", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        saved.alias("saved"),
    )
    known = cut(known, "trie-known")
    chains = known.groupBy("conv_id").agg(
        F.sum("saved").alias("saved"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf")
    )
    rows_of = rows.join(chains, "conv_id", "left").fillna(0, ["saved", "leaf"])
    below = rolled_up(rows_of, "sum(saved) AS chains, sum(leaf) AS n_leaves", width).select(*KEY, "chains", "n_leaves")
    above = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    known = known.withColumn("above", F.coalesce(F.sum("saved").over(above), F.lit(0)))
    out = known.join(below, KEY).join(ending_digests(rows, width), KEY, "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("chains") - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
