"""Prefix trie of conversations by the Euler-tour technique.

A node is a distinct sequence of first turns, known by its smallest member and its depth. Every
node has an arc into it and one out of it; the arcs form one list, the tour. The list is ranked
without ever lying in one task: runs of arcs that lie in one block are contracted first, then
half of the neighbours of what remains are merged, coin by coin, until a bounded number is left
to walk; the merges are undone in reverse. The ranks are prefix sums of the arcs' weights, so a
subtree's leaves and savings are differences between the places of its top's two arcs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ledgerlake.functions.ordinals import dense_ordinal
from ledgerlake.llm.common import run_starts, stage
from ledgerlake.operators.lookup import hot_keys, left_lookup

SHARED = 6  # a conversation begins with fewer than this many turns of its base
FAMILY = 100
BLOCK_ARCS = 1 << 17  # arcs contracted at once inside a task
WALKED = 1 << 16  # runs that one task may walk; a fixed bound, whatever the input
_LISTED = 8192  # ids joined into one string at a time
_PIECES = 4  # 32-bit pieces of a turn's digest; their exact sums name a prefix
_ROOT = "-".join(["0"] * (_PIECES + 1))
_SUMS = ("arcs", "leaves", "saved")


# --- running sums within groups of any size ---


def running(rows: DataFrame, group: str, order: list[str], sums: dict, label: str) -> DataFrame:
    """``rows`` with the running sum of each column of ``sums`` (not negative) in its group.

    Rows are range partitioned by group and order, so one group may span many tasks: a task sums
    what it holds, and a group's sums in earlier tasks, one row a task, are added after.
    """
    names = list(sums)
    kept = [c for c in rows.columns if c not in order or c in (group, "depth", "p", "seg")]
    ordered = (
        rows.withColumns(sums).repartitionByRange(group, *order).sortWithinPartitions(group, *order).select(*kept, *names)
    )
    at, places = kept.index(group), [len(kept) + i for i in range(len(names))]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, last, carry = TaskContext.get().partitionId(), None, np.zeros(len(names), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            groups = batch.column(at).to_numpy()
            values = np.stack([batch.column(i).to_numpy() for i in places], 1)
            starts, summed = run_starts(groups), np.cumsum(values, 0)
            counts = np.diff(np.append(starts, len(groups)))
            summed -= np.repeat(summed[starts] - values[starts], counts, 0)
            if last is not None and groups[0] == last:
                summed[: counts[0]] += carry
            last, carry = groups[-1], summed[-1].copy()
            columns = [batch.column(i) for i in range(len(kept))] + [pa.array(summed[:, i]) for i in range(len(names))]
            columns.append(pa.array(np.full(len(groups), task, np.int32)))
            yield pa.RecordBatch.from_arrays(columns, [*kept, *names, "_task"])

    fields = [ordered.schema[c] for c in kept] + [StructField(c, LongType()) for c in names] + [StructField("_task", IntegerType())]
    placed = stage(ordered.mapInArrow(scan, StructType(fields)), label)
    held = placed.groupBy(F.col("_task").alias("_in"), F.col(group).alias("_group")).agg(*[F.max(c).alias(c) for c in names])
    # One row for each group and task; a group in several tasks is the last of one and the first of the next.
    whole = Window.partitionBy("_group")
    earlier = whole.orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    spans = held.withColumn("_n", F.count("*").over(whole)).filter("_n > 1")
    before = spans.select("_in", "_group", *[F.sum(c).over(earlier).alias(f"_{c}") for c in names])
    match = (F.col("_task") == F.col("_in")) & (F.col(group) == F.col("_group"))
    added = placed.join(before, match, "left").withColumns({c: F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0)) for c in names})
    return added.select(*kept, *names)


# --- the tour as a linked list ---


def _arrays(batch: pa.RecordBatch | pa.Table, names: list[str]) -> list[np.ndarray]:
    out = []
    for name in names:
        column = batch.column(name)
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        out.append(column.fill_null(-1).to_numpy(zero_copy_only=False))
    return out


def _blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def contract(a, b, na, nb, weights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block of list elements (a, b) with their next ones: each element's first predecessor
    in the block, the weights from there up to it, and the last element of its run.

    ``nb`` is -1 at the end of the list.
    """
    n = len(a)
    names, dense = np.unique(np.concatenate([a, na]), return_inverse=True)
    own, following = (dense[:n] << 33) | b, np.where(nb < 0, -1, (dense[n:] << 33) | np.maximum(nb, 0))
    order = np.argsort(own)
    place = order[np.minimum(np.searchsorted(own[order], following), n - 1)]
    inside = own[place] == following
    top = np.arange(n)
    top[place[inside]] = np.flatnonzero(inside)
    offset = np.where((top != np.arange(n))[:, None], weights[top], 0)
    while True:  # pointer jumping inside the block
        above = top[top]
        if (above == top).all():
            break
        offset, top = offset + offset[top], above
    last = np.arange(n)
    tails = np.flatnonzero(~inside)
    last[top[tails]] = tails
    return top, offset, last


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every element with its run's head and its offset there; a head also with its run's next and weight."""
    for block in _blocks(batches, BLOCK_ARCS):
        a, b, na, nb, *w = _arrays(block, ["a", "b", "na", "nb", *_SUMS])
        weights = np.stack(w, 1)
        top, offset, last = contract(a, b, na, nb, weights)
        head = top == np.arange(len(a))
        whole = offset[last] + weights[last]
        columns = [pa.array(x) for x in (a, b, a[top], b[top], *offset.T)]
        columns += [pa.array(na[last], mask=~head | (nb[last] < 0)), pa.array(nb[last], mask=~head | (nb[last] < 0))]
        columns += [pa.array(x, mask=~head) for x in whole.T]
        yield pa.RecordBatch.from_arrays(columns, ["a", "b", "ha", "hb", *[f"o_{c}" for c in _SUMS], "na", "nb", *_SUMS])


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in _blocks(batches, 1 << 62):
        a, b, na, nb, *w = _arrays(block, ["a", "b", "na", "nb", *_SUMS])
        _, offset, _ = contract(a, b, na, nb, np.stack(w, 1))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (a, b, *offset.T)], ["a", "b", *[f"p_{c}" for c in _SUMS]])


def list_rank(arcs: DataFrame, walked: int = WALKED) -> DataFrame:
    """(a, b, p_*): for each element (a, b, na, nb, weights) of one list the weights before it.

    Two neighbours merge where the first one's coin shows 0 and the second one's 1: a quarter of
    the elements goes in each round, so all rounds together move a few times the input.
    """
    longs = lambda names: ", ".join(f"{c} long" for c in names)
    offsets, places = [f"o_{c}" for c in _SUMS], [f"p_{c}" for c in _SUMS]
    ordered = arcs.repartitionByRange("a", "b").sortWithinPartitions("a", "b")
    local = stage(ordered.mapInArrow(_contracted, longs(["a", "b", "ha", "hb", *offsets, "na", "nb", *_SUMS])), "trie-runs")
    left, merges, round_ = local.filter("a = ha and b = hb").select("a", "b", "na", "nb", *_SUMS), [], 0
    while left.count() > walked:
        coin = F.xxhash64("a", "b", F.lit(round_)).bitwiseAND(F.lit(1))
        second = left.filter(coin == 1).select(*[F.col(c).alias(f"s_{c}") for c in left.columns])
        pairs = stage(left.filter(coin == 0).join(second, (F.col("na") == F.col("s_a")) & (F.col("nb") == F.col("s_b")), "full_outer"), "trie-pairs")
        both = F.col("a").isNotNull() & F.col("s_a").isNotNull()
        merges.append(pairs.filter(both).select(F.col("s_a").alias("a"), F.col("s_b").alias("b"), F.col("a").alias("ha"), F.col("b").alias("hb"), *[F.col(c).alias(f"o_{c}") for c in _SUMS]))
        taken = F.col("s_a").isNotNull()
        left = pairs.select(
            *[F.coalesce(c, f"s_{c}").alias(c) for c in ("a", "b")],
            *[F.when(taken, F.col(f"s_{c}")).otherwise(F.col(c)).alias(c) for c in ("na", "nb")],
            *[(F.coalesce(F.col(c), F.lit(0)) + F.coalesce(F.col(f"s_{c}"), F.lit(0))).alias(c) for c in _SUMS],
        )
        round_ += 1
    # At most ``walked`` rows of seven numbers.
    ranks = stage(left.repartition(1).mapInArrow(_walked, longs(["a", "b", *places])), "trie-ranks")
    for merge in reversed(merges):
        ranks = stage(ranks.union(_placed(merge, ranks)), "trie-ranks")
    return _placed(local, ranks)


def _placed(rows: DataFrame, ranks: DataFrame) -> DataFrame:
    heads = ranks.select(F.col("a").alias("ha"), F.col("b").alias("hb"), *[f"p_{c}" for c in _SUMS])
    return rows.join(heads, ["ha", "hb"]).select("a", "b", *[(F.col(f"p_{c}") + F.col(f"o_{c}")).alias(f"p_{c}") for c in _SUMS])


def euler_tour(nodes: DataFrame) -> DataFrame:
    """The arcs (a, b, na, nb, weights) of a tree whose nodes are named by (conv_id, depth).

    ``nodes``: conv_id, depth, parent_conv_id, n_children, first_child, sibling, saved. The arc
    into a node has b = 2 * depth, the one out of it b = 2 * depth + 1.
    """
    into, out = F.col("depth") * 2, F.col("depth") * 2 + 1
    inner = F.col("n_children") > 0
    enter = nodes.select(
        F.col("conv_id").alias("a"), into.alias("b"),
        F.when(inner, F.col("first_child")).otherwise(F.col("conv_id")).alias("na"), F.when(inner, into + 2).otherwise(out).alias("nb"),
        F.lit(1).cast("long").alias("arcs"), (~inner).cast("long").alias("leaves"), "saved",
    )
    more = F.col("sibling").isNotNull()
    leave = nodes.select(
        F.col("conv_id").alias("a"), out.alias("b"),
        F.when(more, F.col("sibling")).otherwise(F.col("parent_conv_id")).alias("na"),
        F.when(more, into).when(F.col("parent_conv_id").isNotNull(), out - 2).alias("nb"),
        F.lit(1).cast("long").alias("arcs"), F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"),
    )
    return enter.union(leave)


# --- the trie ---


def _nodes(members: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes with their parent, number of children, first child and next sibling."""
    plain = members.groupBy("node", "parent_node", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("chars").alias("chars")
    )
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = root.select(F.lit(_ROOT).alias("node"), F.lit(None).cast("string").alias("parent_node"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs", F.lit(0).cast("long").alias("chars"))
    nodes = stage(plain.unionByName(root), "trie-nodes")
    # Each parent once: its children were counted on the map side.
    parents = stage(nodes.filter("parent_node is not null").groupBy("parent_node").agg(F.count("*").alias("_rows"), F.min("conv_id").alias("first_child")), "trie-parents")
    names = nodes.select(F.col("node").alias("parent_node"), F.col("conv_id").alias("parent_conv_id"))
    named = left_lookup(nodes, names, {"parent_node": "parent_node"}, "node", hot_keys(parents, ["parent_node"]))
    children = parents.select(F.col("parent_node").alias("node"), F.col("_rows").alias("n_children"), "first_child")
    named = named.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    ranked = stage(dense_ordinal(named, ["depth", "parent_conv_id", "conv_id"]), "trie-siblings")
    after = ranked.select((F.col("ordinal") - 1).alias("ordinal"), F.col("depth").alias("_d"), F.col("parent_conv_id").alias("_p"), F.col("conv_id").alias("_c"))
    next_one = F.when((F.col("_d") == F.col("depth")) & (F.col("_p") == F.col("parent_conv_id")), F.col("_c"))
    return ranked.join(after, "ordinal", "left").withColumn("sibling", next_one).drop("ordinal", "_d", "_p", "_c")


def _ends(members: DataFrame, convs: DataFrame) -> DataFrame:
    """(node, ends_sha256): the ids that end in a node, in order, as one digest.

    A digest is a chain, so a node's ids pass through one task; they come as strings of many ids,
    made where the sorted ids of a large node lie spread, and are never held together.
    """

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, ids = batch.column("node").dictionary_encode(), batch.column("conv_id").to_numpy()
            keys = nodes.indices.to_numpy()
            cuts = np.union1d(run_starts(keys), np.arange(0, len(keys), _LISTED)).tolist()
            texts = [",".join(map(str, ids[lo:hi].tolist())) for lo, hi in zip(cuts, [*cuts[1:], len(keys)])]
            yield pa.RecordBatch.from_arrays([batch.column("node").take(pa.array(cuts, pa.int64())), pa.array(ids[cuts], pa.int64()), pa.array(texts, pa.string())], ["node", "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_node, chain, found = None, None, []
        for batch in batches:
            for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if node != open_node:
                    if chain:
                        found.append((open_node, chain.hexdigest()))
                    open_node, chain = node, hashlib.sha256(ids.encode())
                else:
                    chain.update(b"," + ids.encode())
            yield _pairs(found)
            found = []
        yield _pairs([(open_node, chain.hexdigest())] if chain else [])

    def _pairs(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], ["node", "ends_sha256"])

    last = members.groupBy("conv_id").agg(F.max_by("node", "depth").alias("node"))
    ends = convs.select("conv_id").join(last, "conv_id", "left").select(F.coalesce("node", F.lit(_ROOT)).alias("node"), "conv_id")
    listed = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(strings, "node string, first long, ids string")
    return listed.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digests, "node string, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame, walked: int = WALKED) -> DataFrame:
    """The nodes of the prefix trie of conversations.

    ``turns``: conv_id, depth (from 1, gapless), digest (of the turn), chars (code points of its
    text); ``convs``: every conv_id once, turnless ones too. A prefix is known by the sums of
    four 32-bit pieces of the SHA-256 of each of its turns with its depth, 128 bits in all.
    Returns node, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256, and enter and exit, the places of the node's arcs in the tour. No conversation
    gives no node.
    """
    hashed = F.sha2(F.concat_ws(":", "depth", "digest"), 256)
    pieces = {f"s{i}": F.conv(F.substring(hashed, 8 * i + 1, 8), 16, 10).cast("long") for i in range(_PIECES)}
    own = turns.select("conv_id", "depth", "chars", *[x.alias(f"x{i}") for i, x in enumerate(pieces.values())])
    summed = running(own, "conv_id", ["depth"], {f"s{i}": F.col(f"x{i}") for i in range(_PIECES)}, "trie-prefixes")
    name = lambda depth, parts: F.concat_ws("-", depth, *[F.lower(F.hex(x)) for x in parts])
    members = summed.select(
        "conv_id", "depth", "chars",
        name(F.col("depth"), [F.col(f"s{i}") for i in range(_PIECES)]).alias("node"),
        name(F.col("depth") - 1, [F.col(f"s{i}") - F.col(f"x{i}") for i in range(_PIECES)]).alias("parent_node"),
    )
    nodes = stage(_nodes(members, convs).withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")), "trie-tree")
    places = list_rank(euler_tour(nodes), walked)
    out = F.col("b").bitwiseAND(F.lit(1)) == 1
    subtrees = places.groupBy(F.col("a").alias("conv_id"), F.shiftright("b", 1).alias("depth")).agg(
        F.max(F.when(~out, F.col("p_arcs"))).alias("enter"),
        F.max(F.when(out, F.col("p_arcs"))).alias("exit"),
        *[F.sum(F.when(out, F.col(f"p_{c}")).otherwise(-F.col(f"p_{c}"))).alias(n) for c, n in (("leaves", "n_leaves"), ("saved", "saved_tokens"))],
    )
    empty = hashlib.sha256(b"").hexdigest()
    return (
        nodes.join(subtrees, ["conv_id", "depth"])
        .join(_ends(members, convs), "node", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(empty)))
        .select("node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "enter", "exit")
    )


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, convs) for :func:`prefix_trie`: each conversation behind the first turns of its base.

    The base of c is c - c % 100; the first h = crc32(c) % 6 turns of c are replaced by the first
    h of the base, or all it has. Turns go by ``turn`` (null first), then role and text.
    """
    empty = F.lit("")
    own = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")
    )
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    turns = own.withColumns({"digest": digest, "chars": F.length("text").cast("long")})
    placed = stage(running(turns, "conv_id", ["turn", "role", "text"], {"p": F.lit(1).cast("long")}, "trie-turns"), "trie-turns")
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED
    convs = stage(placed.groupBy("conv_id").agg(F.max("p").alias("p")).select("conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base")), "trie-convs")
    # At most FAMILY conversations and SHARED turns for each base.
    first = placed.filter(f"p < {SHARED} and conv_id % {FAMILY} = 0").select(F.col("conv_id").alias("base"), "p", "digest", "chars")
    borrowed = convs.join(first, "base").filter(F.col("p") <= shared).select("conv_id", F.lit(0).alias("seg"), "p", "digest", "chars")
    kept = placed.filter(F.col("p") > shared).select("conv_id", F.lit(1).alias("seg"), "p", "digest", "chars")
    return running(borrowed.union(kept), "conv_id", ["seg", "p"], {"depth": F.lit(1).cast("long")}, "trie-rebuilt"), convs


def op11_prefix_trie(conversations: DataFrame) -> DataFrame:
    """The prefix trie of all rebuilt conversations.

    A null role or text is empty; rows without a conv_id take no part; turns of equal number go
    by role, then text, and repeated rows are repeated turns; a text of any length counts whole;
    an empty table gives no row; other columns are ignored.
    """
    turns, convs = rebuilt(conversations)
    return prefix_trie(turns, convs).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
