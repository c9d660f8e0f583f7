"""K-d tree sharding: recursive weighted medians along the widest metadata dimension.

Only DataFrame functions. A median is found by radix selection on a 63-bit key
(20 bits of the coordinate, 43 bits of tie-break): one small histogram per 13 bits,
all nodes of a level in the same job, so nothing is sorted and nothing but one row
per node reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import stage

_TIE_BITS = 43
_COORDINATE = (1 << 20) - 1
_SHIFTS = (50, 37, 24, 11, 0)
_TASK_BITS = 33


def text_metadata(text: str = "text") -> dict[str, Column]:
    """Dimensions of a document taken from its text alone, so copies of a text share them all."""
    body = F.coalesce(F.col(text), F.lit(""))
    chars = F.length(body)
    return {
        "size": F.log2(F.octet_length(body) + 1.0),
        "width": (F.octet_length(body) + 1.0) / (chars + 1.0),  # bytes a character: the script
        "word": (chars + 1.0) / (chars - F.length(F.replace(body, F.lit(" "))) + 1.0),  # characters a word
    }


def kd_shards(
    docs: DataFrame,
    shards: int | None = 8,
    target_bytes: int | None = None,
    id_col: str = "doc_id",
    text: str = "text",
    dims: dict[str, Column] | None = None,
) -> DataFrame:
    """Put every row of ``docs`` into one leaf of a K-d tree of near equal bytes.

    Give the number of ``shards``, or None and the ``target_bytes`` of a leaf. Returns
    (id_col, size, text_crc32, shard, slot); size is the text's UTF-8 bytes plus 1, slots
    are gapless from 0 in each shard. Equal texts share a shard; only a group larger than a
    whole shard is cut, by id and place. ``dims`` must be the same for equal texts.
    A null text counts as empty; a repeated id keeps each of its rows; a null dimension
    counts as the smallest; an empty table gives no row; a very long text is one row of
    its size and may make its shard larger than others; other columns are ignored.
    """
    dims = dims or text_metadata(text=text)
    body = F.coalesce(F.col(text), F.lit(""))
    points = stage(
        docs.select(
            F.col(id_col),
            (F.octet_length(body) + F.lit(1)).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.xxhash64(body).alias("_group"),
            F.monotonically_increasing_id().alias("_at"),
            *[value.cast("double").alias(f"_d{i}") for i, value in enumerate(dims.values())],
        ),
        "kd-points",
    )
    total = points.agg(F.sum("size")).first()[0] or 0
    leaves = shards or max(1, -(-total // target_bytes))
    heavy = _heavy_groups(points, total, leaves)
    own = F.when(F.col("_group").isin(heavy), F.xxhash64("_group", id_col, "_at")).otherwise(F.xxhash64("_group"))
    points = points.withColumn("_tie", F.shiftrightunsigned(own, 64 - _TIE_BITS))
    bounds = points.agg(*[f(f"_d{i}").alias(f"{n}{i}") for i in range(len(dims)) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    spans = [(bounds[f"lo{i}"] or 0.0, (bounds[f"hi{i}"] or 0.0) - (bounds[f"lo{i}"] or 0.0)) for i in range(len(dims))]

    def key(i: int) -> Column:
        low, span = spans[i]
        place = F.round((F.col(f"_d{i}") - F.lit(low)) / F.lit(span or 1.0) * _COORDINATE).cast("long")
        return F.shiftleft(F.coalesce(place, F.lit(0)), _TIE_BITS) + F.col("_tie")

    shard = _leaf(points, leaves, spans, key)
    return _numbered(points.select(id_col, "size", "text_crc32", shard.cast("int").alias("shard")))


def _heavy_groups(points: DataFrame, total: int, leaves: int) -> list[int]:
    """Groups larger than a whole shard: fewer than there are shards."""
    limit = total / max(1, leaves)
    groups = points.groupBy("_group").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    return [row["_group"] for row in groups.filter((F.col("bytes") > limit) & (F.col("n") > 1)).collect()]


def _leaf(points: DataFrame, leaves: int, spans, key) -> Column:
    """The leaf number as an expression over at most ``leaves - 1`` cuts."""
    node = F.lit(0)
    open_nodes = {0: leaves}  # node (named by its first leaf) -> leaves below it
    while any(below > 1 for below in open_nodes.values()):
        active = [n for n, below in open_nodes.items() if below > 1]
        placed = points.withColumn("_node", node).filter(F.col("_node").isin(active))
        stats = placed.groupBy("_node").agg(
            F.sum("size").alias("weight"),
            *[(F.max(f"_d{i}") - F.min(f"_d{i}")).alias(f"w{i}") for i in range(len(spans))],
        )
        plan = {}
        for row in stats.collect():
            widths = [(row[f"w{i}"] or 0.0) / (span or 1.0) for i, (_, span) in enumerate(spans)]
            below = open_nodes[row["_node"]]
            plan[row["_node"]] = {
                "dim": max(range(len(widths)), key=lambda i: (widths[i], -i)),
                "goal": row["weight"] * (below // 2) / below,
            }
        cuts = _weighted_cuts(placed, plan, key)
        following, moved = {}, node
        for n, below in open_nodes.items():
            left = below // 2
            if below < 2:
                following[n] = below
                continue
            following[n], following[n + left] = left, below - left
            if n in cuts:
                moved = F.when((node == n) & (key(plan[n]["dim"]) >= F.lit(cuts[n])), F.lit(n + left)).otherwise(moved)
        node, open_nodes = moved, following
    return node


def _weighted_cuts(placed: DataFrame, plan: dict, key) -> dict[int, int]:
    """For each node the key at which its bytes come nearest to the goal."""
    if not plan:
        return {}
    own_key = None
    for n, x in plan.items():
        own_key = F.when(F.col("_node") == n, key(x["dim"])) if own_key is None else own_key.when(F.col("_node") == n, key(x["dim"]))
    keyed = placed.select("_node", "size", own_key.alias("_key"))
    state = {n: {"prefix": 0, "goal": x["goal"]} for n, x in plan.items()}
    cuts: dict[int, int] = {}
    upper = 63
    for shift in _SHIFTS:
        wanted = F.lit(False)
        for n, s in state.items():
            wanted = wanted | ((F.col("_node") == n) & (F.shiftright("_key", upper) == F.lit(s["prefix"])))
        histogram = (
            keyed.filter(wanted)
            .groupBy("_node", F.shiftright("_key", shift).alias("_bin"))
            .agg(F.sum("size").alias("weight"), F.count_distinct("_key").alias("keys") if not shift else F.count("*").alias("keys"))
        )
        before = Window.partitionBy("_node").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
        goal = F.create_map(*[F.lit(x) for n, s in state.items() for x in (n, float(s["goal"]))])
        running = histogram.withColumn("before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        hit = running.filter((F.col("before") + F.col("weight") >= goal[F.col("_node")]) & (F.col("before") <= goal[F.col("_node")]))
        first = {}
        for row in hit.groupBy("_node").agg(F.min_by(F.struct("_bin", "before", "weight", "keys"), "_bin").alias("x")).collect():
            first[row["_node"]] = row["x"]
        following = {}
        for n, s in state.items():
            x = first[n]
            if x["keys"] == 1 or not shift:
                nearer = s["goal"] - x["before"] <= x["before"] + x["weight"] - s["goal"]
                cuts[n] = (x["_bin"] if nearer else x["_bin"] + 1) << shift
            else:
                following[n] = {"prefix": x["_bin"], "goal": s["goal"] - x["before"]}
        state, upper = following, shift
        if not state:
            break
    return cuts


def _numbered(rows: DataFrame) -> DataFrame:
    """``slot``: rows of the shard in earlier tasks, plus the place among those of the own task."""
    placed = stage(rows.withColumn("_slot", F.monotonically_increasing_id()), "kd-slots")
    placed = placed.withColumn("_task", F.shiftrightunsigned("_slot", _TASK_BITS))
    earlier = Window.partitionBy("shard").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each shard and task.
    starts = placed.groupBy("shard", "_task").agg(F.count("*").alias("_rows")).select(
        "shard", "_task", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start")
    )
    within = Window.partitionBy("_task", "shard").orderBy("_slot")  # a group is part of one task's rows
    return (
        placed.withColumn("_place", F.row_number().over(within) - 1)
        .join(starts, ["shard", "_task"])
        .withColumn("slot", (F.col("_start") + F.col("_place")).cast("long"))
        .drop("_slot", "_task", "_place", "_start")
    )


def op10_kd_shards(docs: DataFrame) -> DataFrame:
    """Eight shards of near equal bytes, in the columns of the sharding contract."""
    return kd_shards(docs, 8).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
