"""SimHash near-duplicates with bit-sliced comparison.

A fingerprint has a bit set where over half of the hashes of the text's shingles have it. Fingerprints that differ in
at most ``RADIUS`` bits are linked; connected ones are a group.

Candidates: the 64 bits are cut into blocks. Two fingerprints within the radius agree in all but ``RADIUS`` of them, so
there is a table for each choice of blocks to agree in, keyed by those blocks. The number of blocks follows from the
number of fingerprints, so that a key holds few unlike ones at any scale; every choice finds every link.

Comparison: the fingerprints of a stretch of sorted keys are stored as 64 bit planes, a lane for each. All pairs at a
distance d in the stretch are compared at once: the planes are combined (xor) with themselves shifted by d lanes, and two
counter planes with a sticky overflow add up the differing bits (carry-save). A word of 64 lanes is abandoned once each of
its lanes has overflowed, has left its key, or is already connected. Found pairs are joined on the spot, so a key
sends on one link for each member, never its pairs. A key of more than ``KEY_ROWS`` fingerprints is dealt to parts, and
every pair of parts is a key of its own, so a hot key becomes many bounded tasks.

Copies share a fingerprint and are compared once. Groups are the components of the links, found by alternating
large-star and small-star steps; what a step has made is kept in the shared folder.

Texts of fewer words than a shingle have one shingle, the words they have; texts without words have fingerprint zero,
linked like any other. Null counts as empty. Repeated rows and null keys each get a row; the smallest key of a group
names it, null only if it has no other. An empty table gives no rows. Columns other than key and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import (
    checkpointed,
    chosen,
    identified,
    own_shuffle,
    schema_of,
    text_function,
)

BITS = 64
RADIUS = 3
SHINGLE = 3
SEED = 42
KEY_ROWS = 1024
UNLIKE_ROWS = 4096  # fingerprints in a key by chance, at most
STRETCH_ROWS = 1 << 16
LOWER_BYTES = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprints(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """One unsigned number for each text."""
    result = np.zeros(len(texts), np.uint64)
    digest = xxhash.xxh64_intdigest
    for n, text in enumerate(texts):
        words = text.translate(LOWER_BYTES).split()
        if not words:
            continue
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.r_[0, ends[:-1] + 1].tolist()
        stops = ends[min(shingle, len(words)) - 1 :].tolist()
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts, stops)], "<u8")
        counts = np.zeros(BITS, np.int64)
        for first in range(0, len(hashes), 1 << 16):
            part = hashes[first : first + (1 << 16)].view(np.uint8).reshape(-1, 8)
            counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        result[n] = np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0]
    return result


def fingerprint(text: str | Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of a text column, as a signed number with the same bits."""

    def measure(texts: list[bytes]) -> list[dict]:
        return [{"bits": bits} for bits in fingerprints(texts, shingle).view(np.int64).tolist()]

    return text_function(measure, schema_of("bits long"))(text)["bits"]


def block_masks(rows: int, radius: int = RADIUS) -> list[int]:
    """For each table, the bits its keys are made of."""
    blocks = radius + 1
    while blocks < 16 and rows / 2 ** (BITS * (blocks - radius) / blocks) > UNLIKE_ROWS:
        blocks += 1
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(masks, blocks - radius)]


def signed(number: int) -> int:
    return number - (1 << 64) if number >= 1 << 63 else number


def keyed(prints: DataFrame, masks: list[int]) -> DataFrame:
    """``bits, band, value, near, far``: each fingerprint under its keys, those of large keys by pairs of parts."""
    tables = F.array(
        *(
            F.struct(F.lit(n).alias("band"), F.col("bits").bitwiseAND(F.lit(signed(mask))).alias("value"))
            for n, mask in enumerate(masks)
        )
    )
    rows = prints.select("bits", F.explode(tables).alias("key")).select(
        "bits", F.xxhash64("key.band", "key.value").alias("key")
    )
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / F.lit(KEY_ROWS)).cast("int").alias("parts")
    shared = rows.join(own_shuffle(counts.select("key", parts), "key"), "key")
    own = F.pmod(F.xxhash64(F.lit(7), F.col("bits")), F.col("parts")).cast("int")
    dealt = shared.select("bits", "key", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    return dealt.select("bits", "key", F.least("own", "other").alias("near"), F.greatest("own", "other").alias("far"))


def planes_of(bits: np.ndarray) -> np.ndarray:
    """Bit planes, 64 lanes to a word, with room to be shifted by any number of lanes."""
    lanes = -(-len(bits) // 64) * 64
    padded = np.zeros(lanes, np.uint64)
    padded[: len(bits)] = bits
    spread = np.unpackbits(padded.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    words = np.packbits(spread.T, axis=1, bitorder="little").copy().view("<u8").astype(np.uint64)
    return np.concatenate([words, np.zeros((BITS, lanes // 64 + 2), np.uint64)], axis=1)


def words_of_lanes(lanes: np.ndarray) -> np.ndarray:
    return np.packbits(lanes, axis=1, bitorder="little").copy().view("<u8").astype(np.uint64)[:, 0]


def connect(label: np.ndarray, a: np.ndarray, b: np.ndarray, rows: np.ndarray) -> None:
    """Give the connected the smallest row of theirs. ``rows`` are all that may change."""
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        apart = low != high
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(label, high[apart], low[apart])
        while True:
            further = label[label[rows]]
            if np.array_equal(further, label[rows]):
                break
            label[rows] = further


def linked(bits: np.ndarray, ends: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each row, the first row of its key that it is connected with. ``ends``: where each row's key ends."""
    n = len(bits)
    label = np.arange(n)
    if not n:
        return label
    planes = planes_of(bits)
    lanes = -(-n // 64) * 64
    left = np.zeros(lanes, np.int64)  # rows behind it in its key
    left[:n] = ends - np.arange(n) - 1
    most = left.reshape(-1, 64).max(axis=1)
    size = ends - np.searchsorted(ends, ends)  # of each row's key
    lane = np.arange(lanes).reshape(-1, 64)
    counters = radius.bit_length()
    for d in range(1, int(most.max()) + 1):
        words = np.flatnonzero(most >= d)
        here = lane[words]
        there = np.minimum(here + d, n - 1)
        label_there = label[there]
        open_lanes = (left.reshape(-1, 64)[words] >= d) & (label[np.minimum(here, n - 1)] != label_there)
        keep = open_lanes.any(axis=1)
        words, alive = words[keep], words_of_lanes(open_lanes[keep])
        if not len(words):
            continue
        at, shift = words + d // 64, np.uint64(d % 64)
        back = np.uint64((64 - d % 64) % 64)
        sums = [np.zeros(len(words), np.uint64) for _ in range(counters)]
        for k in range(BITS):
            plane = planes[k]
            moved = plane[at] if d % 64 == 0 else (plane[at] >> shift) | (plane[at + 1] << back)
            carry = plane[words] ^ moved
            for i in range(counters):
                sums[i], carry = sums[i] ^ carry, sums[i] & carry
            alive &= ~carry  # overflow: over 2**counters - 1 differing bits
            if k % 8 == 7:
                active = alive != 0
                if not active.any():
                    break
                if active.sum() * 4 < 3 * len(active):
                    words, at, alive = words[active], at[active], alive[active]
                    sums = [s[active] for s in sums]
        if not alive.any():
            continue
        found = np.flatnonzero(alive)
        spread = np.unpackbits(alive[found].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        which, offset = np.nonzero(spread)
        a = words[found[which]] * 64 + offset
        b = a + d
        near = np.bitwise_count(bits[a] ^ bits[b]) <= radius
        connect(label, a[near], b[near], np.flatnonzero(size > d))
    return label


def link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among rows sorted by key; a stretch ends with a key."""
    held: list[pa.Table] = []
    size = 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        size += len(batch)
        if size >= STRETCH_ROWS:
            table = pa.concat_tables(held)
            starts = key_starts(table)
            if len(starts) > 1:  # the last key may go on in the next batch
                yield links_of(table.slice(0, int(starts[-1])))
                table = table.slice(int(starts[-1]))
            held, size = [table], len(table)
    if held:
        yield links_of(pa.concat_tables(held))


def key_starts(table: pa.Table) -> np.ndarray:
    new = np.zeros(len(table), bool)
    new[:1] = True
    for name in ("key", "near", "far"):
        values = table[name].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def links_of(table: pa.Table) -> pa.RecordBatch:
    bits = table["bits"].to_numpy().astype(np.int64)
    starts = key_starts(table)
    stops = np.r_[starts[1:], len(table)]
    label = linked(bits.view(np.uint64), np.repeat(stops, stops - starts))
    other = np.flatnonzero(label != np.arange(len(label)))
    return pa.RecordBatch.from_arrays([pa.array(bits[other]), pa.array(bits[label[other]])], ["a", "b"])


def links(prints: DataFrame, rows: int) -> DataFrame:
    """``a, b``: links that connect what is within the radius, at most one for each fingerprint and key."""
    dealt = keyed(prints, block_masks(rows))
    stretch = dealt.repartition("key", "near", "far").sortWithinPartitions("key", "near", "far", "bits")
    return stretch.mapInArrow(link_batches, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``bits, root`` for each end of an edge: the smallest number connected with it.

    In a large-star step a node links its larger neighbours to the smallest node around it, in a small-star step its smaller
    neighbours and itself; the edges become stars around the smallest node of each component.
    """
    ends = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")  # from here on a > b
    edges = checkpointed(edges.select(*ends).filter("a <> b").distinct())
    before = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        around = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.filter("b > a").join(own_shuffle(around, "a"), "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.filter("a <> b").distinct()
        below = large.groupBy("a").agg(F.min("b").alias("least"))
        joined = large.join(own_shuffle(below, "a"), "a")
        small = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionAll(below.select("a", F.col("least").alias("b")))
        edges = checkpointed(small.filter("a <> b").distinct())
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("a").alias("bits"), F.col("b").alias("root")).unionAll(
        edges.select(F.col("b").alias("bits"), F.col("b").alias("root")).distinct()
    )


def groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    carried: list[str] | None = None,
) -> DataFrame:
    """``key, bits, root, component_id`` for each row, and the ``carried`` columns; ``root`` is a group's own number."""
    carried = carried or []
    bits = fingerprint(F.col(text), shingle).alias("bits")
    rows = checkpointed(docs.select(F.col(key).alias("key"), bits, *carried))
    prints = checkpointed(rows.groupBy("bits").agg(F.min("key").alias("first")))
    rooted = components(links(prints.select("bits"), prints.count()))
    nodes = prints.join(rooted, "bits", "left").withColumn("root", F.coalesce("root", "bits"))
    smallest = nodes.groupBy("root").agg(F.min("first").alias("component_id"))
    named = nodes.join(own_shuffle(smallest, "root"), "root").select("bits", "root", "component_id")
    return rows.join(checkpointed(named), "bits").select(
        F.col("key").alias(key), "bits", "root", "component_id", *carried
    )


def as_hex(bits: str) -> Column:
    return F.lpad(F.lower(F.hex(bits)), 16, "0")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The row with the smallest key of each group, with the columns it came with."""
    rows, names = identified(docs)
    found = groups(rows, key, text, carried=names)
    smallest = F.min(F.struct(F.col(key).isNull(), F.col(key), *names)).alias("kept")
    kept = found.groupBy("root").agg(smallest).select(*(F.col("kept")[name].alias(name) for name in names))
    return chosen(rows, kept, names)
