"""Phrase collocations: Misra-Gries summaries for each hash partition, then exact counts of what they keep.

First pass: every phrase of up to ``longest`` words is hashed (64 bits, with its language). A task sums up the hashes of
a few MB of text at a time and sends a summary for each bucket, a range of hashes. Of a bucket the masses come first, so
its capacity, ``SLACK`` times the mass divided by ``least`` and one more, is known before its summaries are merged. A merged
summary that exceeds the capacity is cut by its first count beyond it, as Misra and Gries do. All cuts of a bucket together stay
below ``least / SLACK``, so a phrase with ``least`` places always survives: kept is each counter that with the cuts reaches
``least``. A bucket's memory is bounded whatever the text; a hot phrase is one counter.

Second pass: hashes that survive set bits of a filter of bounded size (``FILTER_BITS``). Only phrases that it lets through are
counted, by their words, in each task and then over all; two phrases that share a hash or a bit are counted apart. A filter
that is too small lets more through and changes no result.

Scores, cuts and containment are joins of the frequent phrases with their own parts; all parts of a frequent phrase are frequent.

Null texts count as empty, a null language as ``und``. Texts without words have no phrases; a language without frequent
phrases has no rows, an empty table none. Repeated rows and null ids count each time. Equal scores go by count, then by
the phrase's bytes. Only the text and the language are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.common import checkpointed

LEAST = 30
LONGEST = 4
COVERED_PCT = 80
TOP = 2000
UNKNOWN = "und"

CHUNK_BYTES = 3 * 1024**2
BATCH_BYTES = 4 * 1024**2
SLACK = 4  # times the least capacity that keeps every frequent phrase
COUNTERS = 1 << 20  # of a bucket, about
FILTER_BITS = 1 << 28
BITS_EACH = 64
BLOCK_BITS = 1 << 16

BREAK = b"\xff"  # stands in no UTF-8 text
SPLIT_BYTES = bytes(
    0xFF if c in b".,;:!?\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else c for c in range(256)
)

Words = tuple[list[bytes], np.ndarray, np.ndarray]


def words_of(texts: list[bytes]) -> Words:
    """The words, a number for each (0: a break, where no phrase goes on), and a hash for each number."""
    line = (b" " + BREAK + b" ").join(texts).translate(SPLIT_BYTES)
    words = line.replace(BREAK, b" " + BREAK + b" ").split()
    number = {BREAK: 0}
    numbers = np.fromiter((number.setdefault(word, len(number)) for word in words), np.int64, len(words))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number))
    return words, numbers, hashes


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Spread what differs over all bits."""
    hashes = hashes ^ (hashes >> np.uint64(32))
    hashes = hashes * np.uint64(0x9E3779B97F4A7C15)
    return hashes ^ (hashes >> np.uint64(29))


def phrase_hashes(lang: str, words: Words, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length the places where a phrase starts, and its hash."""
    _, numbers, hashes = words
    own, one = hashes[numbers], numbers > 0
    total, whole = own ^ np.uint64(xxhash.xxh64_intdigest(lang.encode())), one
    for size in range(1, longest + 1):
        if size > 1:
            total = mixed(total[:-1]) + own[size - 1 :]
            whole = whole[:-1] & one[size - 1 :]
        at = np.flatnonzero(whole)
        yield size, at, mixed(total[at])


def in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list[bytes]]]:
    """The texts of a few MB, by language. No text is cut."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1).cast(pa.binary())):
            data = text.as_py()
            held.setdefault(lang.as_py(), []).append(data)
            size += len(data)
            if size >= CHUNK_BYTES:
                yield held
                held, size = {}, 0
    if held:
        yield held


def summaries(buckets: int, longest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each bucket a summary of each part of the texts, and a row with the task's mass (it sorts first)."""
    edges = np.array([-(-(b << 64) // buckets) for b in range(1, buckets)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass = np.zeros(buckets, np.int64)
        for part in in_parts(batches):
            found = [
                hashes
                for lang, texts in part.items()
                for _, _, hashes in phrase_hashes(lang, words_of(texts), longest)
            ]
            keys, counts = np.unique(np.concatenate(found), return_counts=True)
            cuts = np.r_[0, np.searchsorted(keys, edges), len(keys)]
            rows = []
            for b in np.flatnonzero(np.diff(cuts)):
                own, times = keys[cuts[b] : cuts[b + 1]], counts[cuts[b] : cuts[b + 1]]
                mass[b] += times.sum()
                rows.append((int(b), 0, packed(own, "<u8"), packed(times, "<u4")))
                if sum(len(row[2]) for row in rows) >= BATCH_BYTES:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)
        yield batch_of([(int(b), int(mass[b]), None, None) for b in np.flatnonzero(mass)])

    return run


SUMMARY = "bucket long, mass long, hashes binary, counts binary"


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
    columns = list(zip(*rows)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], SUMMARY.replace(",", "").split()[::2])


def packed(numbers: np.ndarray, kind: str) -> bytes:
    """A plane for each byte of the numbers: the high ones of sorted numbers compress well."""
    planes = numbers.astype(kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize)
    return np.ascontiguousarray(planes.T).tobytes()


def unpacked(data: bytes | pa.Buffer, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind)[:, 0]


class Summary:
    """Misra-Gries counters of one bucket. ``cut``: what a counter may lack."""

    def __init__(self, capacity: int):
        self.capacity, self.cut = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.size += len(keys)
        if self.size > self.capacity:
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)])
        self.waiting, self.size = [], 0
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        self.keys, self.counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
        if len(self.keys) > self.capacity:
            beyond = len(self.counts) - self.capacity - 1
            cut = np.partition(self.counts, beyond)[beyond]  # the largest count that has no counter
            self.cut += int(cut)
            stay = self.counts > cut
            self.keys, self.counts = self.keys[stay], self.counts[stay] - cut

    def frequent(self, least: int) -> np.ndarray:
        self.merge()
        return self.keys[self.counts + np.uint64(self.cut) >= least]


def merged(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Hashes that may have ``least`` places, from rows sorted by bucket, masses first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, mass, summary = None, 0, None

        def ended() -> Iterator[pa.RecordBatch]:
            if summary is not None:
                yield pa.RecordBatch.from_arrays([pa.array(summary.frequent(least).view(np.int64))], ["hash"])

        for batch in batches:
            for b, m, keys, counts in zip(batch[0].to_pylist(), batch[1].to_pylist(), batch[2], batch[3]):
                if b != bucket:
                    yield from ended()
                    bucket, mass, summary = b, 0, None
                mass += m
                if keys.is_valid:
                    summary = summary or Summary(SLACK * (mass // least + 1))
                    summary.add(unpacked(keys.as_buffer(), "<u8"), unpacked(counts.as_buffer(), "<u4").astype(np.uint64))
        yield from ended()

    return run


class Filter:
    """A bit for each range of hashes: set if a hash in it survived."""

    def __init__(self, survivors: DataFrame):
        wanted = min(max(BITS_EACH * survivors.count(), BLOCK_BITS), FILTER_BITS)
        self.shift = 64 - (wanted - 1).bit_length()
        self.bits = np.zeros((1 << (64 - self.shift)) // 8, np.uint8)
        shift = np.uint64(self.shift)

        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            set_bits = [np.unique(batch.column(0).to_numpy().view(np.uint64) >> shift) for batch in batches]
            at = np.unique(np.concatenate(set_bits)).astype(np.int64) if set_bits else np.zeros(0, np.int64)
            numbers, starts = np.unique(at // BLOCK_BITS, return_index=True)
            data = []
            for number, own in zip(numbers, np.split(at, starts[1:])):
                bits = np.zeros(BLOCK_BITS, np.uint8)
                bits[own - number * BLOCK_BITS] = 1
                data.append(np.packbits(bits).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(data, pa.binary())], ["block", "bits"])

        for row in survivors.mapInArrow(blocks, "block long, bits binary").collect():  # FILTER_BITS at most, and edges
            start = row["block"] * (BLOCK_BITS // 8)
            self.bits[start : start + BLOCK_BITS // 8] |= np.frombuffer(row["bits"], np.uint8)

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes >> np.uint64(self.shift)).astype(np.int64)
        return (self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def counted(words: Words, at: np.ndarray, size: int) -> Iterator[tuple[bytes, int]]:
    """The phrases of ``size`` words that start at the places, with their number. Equal means equal words."""
    names, numbers, hashes = words
    code = numbers[at]
    for k in range(1, size):
        _, code = np.unique(code * len(hashes) + numbers[at + k], return_inverse=True)
    _, first, times = np.unique(code, return_index=True, return_counts=True)
    for place, count in zip(at[first].tolist(), times.tolist()):
        yield b" ".join(names[place : place + size]), count


def exact(texts: DataFrame, survivors: DataFrame, longest: int) -> DataFrame:
    """``lang, words, phrase, a`` of all phrases the filter lets through; of 0 words: all words of the language."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(Filter(survivors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_parts(batches):
            rows: list[tuple[str, int, bytes, int]] = []
            for lang, own in part.items():
                words = words_of(own)
                rows.append((lang, 0, b"", int((words[1] > 0).sum())))
                for size, at, hashes in phrase_hashes(lang, words, longest):
                    hits = at[shared.value.passes(hashes)]
                    rows += [(lang, size, phrase, times) for phrase, times in counted(words, hits, size)]
            kinds = (pa.string(), pa.int32(), pa.binary(), pa.int64())
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
            columns[2] = columns[2].cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, ["lang", "words", "phrase", "a"])

    counts = texts.mapInArrow(run, "lang string, words int, phrase string, a long")
    return counts.groupBy("lang", "words", "phrase").agg(F.sum("a").alias("a"))


def part_of(start: Column | int, size: Column | int) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), start, size), " ")


def scored(frequent: DataFrame) -> DataFrame:
    """``lang, phrase, words, a, l, r, score`` of each phrase of two words or more, by its lowest cut."""
    known = frequent.select("lang", "phrase", "a")
    firsts, rests = (known.select("lang", F.col("phrase").alias(p), F.col("a").alias(n)) for p, n in (("first", "l"), ("rest", "r")))
    cuts = frequent.filter("words > 1").select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumns({"first": part_of(1, F.col("k")), "rest": part_of(F.col("k") + 1, F.col("words") - F.col("k"))})
    met = cuts.join(firsts, ["lang", "first"]).join(rests, ["lang", "rest"])
    wide = (F.col(c).cast("decimal(20,0)") for c in "alr")
    a, left, right = wide
    score = F.call_function("div", a * F.lit(2_000_000), left + right)
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return met.groupBy("lang", "phrase", "words", "a").agg(lowest).select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def uncovered(candidates: DataFrame, covered_pct: int) -> DataFrame:
    """Candidates without those that a longer one contains about as often."""
    longer = candidates.filter("words > 2").select("lang", "words", "phrase", F.col("a").alias("most"))
    sizes = longer.select("*", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"))
    starts = sizes.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("start"))
    within = starts.select("lang", "most", part_of(F.col("start"), F.col("size")).alias("phrase"))
    within = within.groupBy("lang", "phrase").agg(F.max("most").alias("most"))
    wide = {c: F.col(c).cast("decimal(20,0)") for c in ("a", "most")}
    kept = F.col("most").isNull() | (wide["most"] * 100 < wide["a"] * covered_pct)
    return candidates.join(within, ["lang", "phrase"], "left").filter(kept).drop("most")


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """``lang, words, phrase, a``: exact counts of all phrases with ``least`` places or more; of 0 words: all words."""
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)), F.coalesce(F.col(text), F.lit("")))
    size = docs.select(F.sum(F.octet_length(text))).first()[0] or 0
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A phrase starts at every second byte at most.
    buckets = max(4 * parts, -(-size * longest * SLACK // (2 * least * COUNTERS)))
    sent = texts.mapInArrow(summaries(buckets, longest), SUMMARY)
    # A partition may cross to Python in one batch, so there are as many as would be buckets at least.
    sent = sent.repartition(4 * parts, "bucket").sortWithinPartitions("bucket", F.col("hashes").isNotNull())
    survivors = checkpointed(sent.mapInArrow(merged(least), "hash long"))
    return checkpointed(exact(texts, survivors, longest).filter((F.col("words") == 0) | (F.col("a") >= least)))


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    covered_pct: int = COVERED_PCT,
    top: int = TOP,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first phrases by score."""
    found = frequent_phrases(docs, text, lang, least, longest)
    totals = found.filter("words = 0").select("lang", F.col("a").alias("n"))
    kept = uncovered(scored(found.filter("words > 0")), covered_pct)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
