"""Mixing sources to target weights by pivotal dependent rounding.

Each source has a target of words. A document's expected number of copies is its source's target over its source's size;
the whole part is taken as it is, the fraction is rounded. Rounding moves words, not just chances, between two
documents at a time: a random one of the two moves that keep the pair's expected words and both expectations makes one
fraction 0 or 1. That document is decided, the other goes on to the next pair. So all but one document of a source are
decided with the words of the source unchanged, and the last one is off by less than its size.

Pairs meet in a reduction tree. A source's documents are dealt by a hash of their key to leaves of about ``LEAF_ROWS``;
each leaf decides all but one, and the undecided ones of ``FAN_IN`` leaves meet in the next level. A source of any size
is thus spread over many tasks, and a level moves one row for each leaf below it.

The hash seeds every draw, so reruns and repeated tasks agree. Null and empty texts have size 0 and are never undecided;
a source of size 0 has target 0. Null is a source of its own, the last. Each of several equal rows is decided alone. An
empty table gives no rows. The columns of the result are the operator's own, so others cannot clash.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from foliospark.llm.common import checkpointed, identified, unused_name

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
LEAF_ROWS = 2048
FAN_IN = 64
SEED = 42
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_copies: int = MOST_COPIES
) -> DataFrame:
    """``source, source_size`` to ``source, source_size, rows, target``: shares by weight, filled up to the caps.

    With the sources in the order of cap over weight, those before some place are at their caps and the rest share what
    is left; that place is the first where the share is below the cap.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array([F.lit(float(w)) for w in weights])
    place = (F.row_number().over(ordered) - 1) % len(weights)
    weighted = sizes.withColumn("weight", F.get(cycle, place))
    weighted = weighted.withColumn("cap", F.col("source_size") * F.lit(float(most_copies)))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    all_sources = Window.partitionBy()
    shared = weighted.select(
        "*",
        (
            (F.sum("source_size").over(all_sources) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            / F.sum("weight").over(after)
        ).alias("level"),
    )
    open_level = F.max(F.when(F.col("cap") > F.col("level") * F.col("weight"), F.col("level"))).over(all_sources)
    return shared.select(
        "source",
        "source_size",
        "rows",
        F.least(F.col("cap"), F.coalesce(open_level * F.col("weight"), F.col("cap"))).alias("target"),
    )


def draw(seed: int, rows: np.ndarray) -> np.ndarray:
    """A number in [0, 1) for each row's hash, the same wherever and whenever it is drawn (SplitMix64)."""
    x = rows.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(np.float64) / 2.0**53


def decide(sizes: list[int], parts: list[float], draws: list[float]) -> tuple[list[float], int | None]:
    """Round the fractions of one group, pair by pair. Returns them, and the place of the one still open."""
    parts = list(parts)
    held: int | None = None
    for i, size in enumerate(sizes):
        if not 0 < parts[i] < 1:
            continue
        if held is None:
            held = i
            continue
        a, b = sizes[held], size
        to_held = min((1 - parts[held]) * a, parts[i] * b)  # the most words that can move so
        from_held = min(parts[held] * a, (1 - parts[i]) * b)
        moved = to_held if draws[i] * (to_held + from_held) < from_held else -from_held
        for n, change in ((held, moved / a), (i, -moved / b)):
            part = parts[n] + change
            parts[n] = 0.0 if part < 1e-12 else 1.0 if part > 1 - 1e-12 else part
        if not 0 < parts[held] < 1:
            held = i if 0 < parts[i] < 1 else None
    return parts, held


def rounding(seed: int, last: bool):
    """Decide the open rows of one (source, leaf). On the last level the one left over is drawn by itself."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("size", "ascending"), ("row", "ascending")])
        rows = group["row"].to_numpy()
        draws = draw(seed, rows)
        parts, held = decide(group["size"].to_pylist(), group["part"].to_pylist(), draws.tolist())
        done = np.ones(len(parts), bool)
        if held is not None and last:
            parts[held] = float(draw(seed + 1, rows[held : held + 1])[0] < parts[held])
        elif held is not None:
            done[held] = False
        names = group.column_names
        decided = {"part": pa.array(parts, pa.float64()), "done": pa.array(done)}
        return pa.table({name: decided.get(name, group[name]) for name in names})

    return run


def copies(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    carried: list[str] | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    most_copies: int = MOST_COPIES,
    seed: int = SEED,
    leaf_rows: int = LEAF_ROWS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """``key, size, source_size, target, copies`` for each row of ``docs``, and the ``carried`` columns.

    A level's result is kept in the shared folder; the next one starts from what is open there.
    """
    carried = carried or []
    rows = checkpointed(
        docs.select(
            F.col(key).alias("key"),
            F.col(source).cast("string").alias("source"),
            word_count(text).alias("size"),
            F.xxhash64(F.col(key), F.col(source), F.col(text)).alias("row"),
            *carried,
        )
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    targets = checkpointed(source_targets(sizes, weights, most_copies)).withColumnRenamed("source", "of")
    ratio = F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0))
    whole = F.floor(ratio + 1e-9)
    part = F.when(F.col("size") > 0, F.greatest(ratio - whole, F.lit(0.0))).otherwise(F.lit(0.0))
    wide = F.ceil(F.col("rows") / F.lit(leaf_rows)).cast("long")
    level = rows.join(targets, F.col("source").eqNullSafe(F.col("of"))).select(
        "key", "source", "size", "row", "source_size", "target",
        whole.cast("long").alias("whole"),
        F.pmod(F.xxhash64(F.lit(seed), F.col("row")), wide).alias("leaf"),
        part.alias("part"),
        F.lit(False).alias("done"),
        *carried,
    )
    schema = StructType([level.schema[name] for name in level.columns])
    leaves = ceil((targets.agg(F.max("rows")).first()[0] or 0) / leaf_rows)
    results, step = [], 0
    while True:
        last = leaves <= 1
        decided = level.groupBy("source", "leaf").applyInArrow(rounding(seed + 2 * step, last), schema)
        decided = checkpointed(decided)
        results.append(decided.filter("done"))
        if last:
            break
        level = decided.filter("NOT done").withColumn("leaf", F.floor(F.col("leaf") / fan_in)).select(schema.names)
        leaves, step = ceil(leaves / fan_in), step + 1
    everything = results[0]
    for more in results[1:]:
        everything = everything.unionAll(more)
    rounded = (F.col("whole") + F.col("part").cast("long")).alias("copies")
    return everything.select(F.col("key").alias(key), "size", "source_size", "target", rounded, *carried)


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with the columns they came with."""
    rows, names = identified(docs)
    taken, place = unused_name(docs, "_taken"), unused_name(docs, "_place")
    counts = copies(rows, key, text, source, names, **options)
    lists = counts.groupBy(*names).agg(F.collect_list("copies").alias(taken))  # one number for each equal row
    nth = F.row_number().over(Window.partitionBy(*names).orderBy(*names))
    times = rows.join(lists, names).withColumn(place, nth)
    times = times.withColumn(taken, F.get(F.col(taken), F.col(place) - 1).cast("int")).filter(F.col(taken) > 0)
    return times.withColumn(place, F.explode(F.sequence(F.lit(1), F.col(taken)))).select(*docs.columns)
