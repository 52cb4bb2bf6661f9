"""Benchmark decontamination: a broadcast hash set of the items' word windows, met by every window of the documents.

A window is ``words`` consecutive words of an item; an item of fewer words, but not none, is one window. Windows are numbered
words with a 64-bit hash; a document's runs of words that items have at all are hashed at every place, looked up, and each
find is verified word by word. The hash set is rebuilt with another seed until its windows' hashes differ.

What tasks get is bounded: long items are cut into overlapping stretches, and the stretches are dealt to as many slices as keep each
below ``slice_bytes``. One slice is a plain projection of the documents. Of several each is scanned for in turn, the finds are
kept in the shared folder and put together for each document.

Null and empty texts have no words and meet nothing. Equal item ids are one item; the windows of a null item id hit, but the id is not listed. Items
that repeat count once. Repeated documents and null ids each get a row. An empty benchmark hits nothing, an empty table gives
no rows. Only the ids and the texts are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from foliospark.llm.common import checkpointed, chunks, identified, schema_of, text_function
from foliospark.llm.licenses import words_of

WORDS = 10
SLICE_BYTES = 16 * 1024**2
STRETCH_WORDS = 10_000
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")  # as words_of takes them

SPANS = "array<struct<start: long, end: long>>"
RESULT = f"n_words long, n_hit long, spans {SPANS}, items array<string>"


def stretches(words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``item, words`` of each stretch: all windows of an item lie in its stretches, and only those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, lines = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                own = words_of(text or b"")
                for start in range(0, max(1, len(own) - words + 1), STRETCH_WORDS):
                    if own:
                        items.append(item)
                        lines.append(b" ".join(own[start : start + STRETCH_WORDS + words - 1]))
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(lines, pa.binary())], ["item", "words"])

    return run


class Windows:
    """The windows of one slice of the items, for each length their words' numbers, hashes and items."""

    def __init__(self, rows: list[tuple[str | None, list[bytes]]], words: int):
        self.number: dict[bytes, int] = {}
        self.items = sorted({item for item, _ in rows if item is not None})
        place = {item: i for i, item in enumerate(self.items)}
        found: dict[int, list[tuple[np.ndarray, int]]] = {}
        for item, own in rows:
            numbers = np.array([self.number.setdefault(word, len(self.number)) for word in own], np.int32)
            size = min(words, len(own))
            windows = np.lib.stride_tricks.sliding_window_view(numbers, size)
            found.setdefault(size, []).append((windows, place.get(item, -1)))
        self.value = np.zeros(0, np.uint64)
        self.tables = {}
        unlike = {size: self.table(parts) for size, parts in found.items()}
        seed = 0
        while len(self.tables) < len(unlike):
            seed += 1
            self.value = np.random.default_rng(seed).integers(0, 1 << 64, len(self.number), np.uint64, endpoint=False)
            self.tables = {}
            for size, (windows, owners, starts) in unlike.items():
                hashes = self.hashes(windows.T)
                order = np.argsort(hashes, kind="stable")
                if (np.diff(hashes[order]) == 0).any():
                    break
                self.tables[size] = (hashes[order], order, windows, owners, starts)

    @staticmethod
    def table(parts: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct windows, and the items of each: owners[starts[k] : starts[k + 1]]."""
        windows, of = np.unique(np.concatenate([w for w, _ in parts]), axis=0, return_inverse=True)
        owner = np.concatenate([np.full(len(w), item) for w, item in parts])
        pairs = np.unique(np.stack([of.ravel(), owner]), axis=1)
        return windows, pairs[1], np.searchsorted(pairs[0], np.arange(len(windows) + 1))

    def hashes(self, columns: np.ndarray | list[np.ndarray]) -> np.ndarray:
        total = np.zeros(len(columns[0]), np.uint64)
        for column in columns:
            total = total * np.uint64(0x9E3779B97F4A7C15) + self.value[column]
        return total

    def found(self, numbers: np.ndarray, known: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each length the places where a window stands, and which. ``known``: words from here on that items have."""
        for size, (hashes, order, windows, _, _) in self.tables.items():
            at = np.flatnonzero(known >= size)
            own = self.hashes([numbers[at + k] for k in range(size)])
            near = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
            hit = hashes[near] == own
            at, which = at[hit], order[near[hit]]
            same = np.ones(len(at), bool)
            for k in range(size):
                same &= numbers[at + k] == windows[which, k]
            yield size, at[same], which[same]

    def measure(self, texts: list[bytes]) -> list[dict]:
        split = [words_of(text) for text in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        records = [{"n_words": n, "n_hit": 0, "spans": [], "items": []} for n in sizes.tolist()]
        if not self.tables:
            return records
        ends = np.cumsum(sizes + 1)  # a place that is no word stands behind each text
        numbers = np.fromiter(
            map(self.number.get, chain.from_iterable(chain(words, (b"",)) for words in split), repeat(-1)),
            np.int32,
            int(ends[-1]),
        )
        unknown = np.flatnonzero(numbers < 0)
        lengths = np.diff(unknown, prepend=-1)
        known = np.repeat(unknown, lengths) - np.arange(len(numbers))
        places: dict[int, list[tuple[np.ndarray, int]]] = {}
        for size, at, which in self.found(numbers, known):
            text = np.searchsorted(ends, at, side="right")
            for n in np.unique(text).tolist():
                own = slice(*np.searchsorted(text, [n, n + 1]))  # places ascend
                start = int(ends[n] - sizes[n] - 1)
                places.setdefault(n, []).append((at[own] - start, size))
                _, _, _, owners, starts = self.tables[size]
                for k in np.unique(which[own]).tolist():
                    records[n]["items"] += owners[starts[k] : starts[k + 1]].tolist()
        for n, hits in places.items():
            records[n] |= {
                "items": [self.items[i] for i in sorted(set(records[n]["items"])) if i >= 0],
                "spans": united((a, a + size) for at, size in hits for a in at.tolist()),
            }
            records[n]["n_hit"] = sum(span["end"] - span["start"] for span in records[n]["spans"])
        return records


def united(spans: Iterator[tuple[int, int]]) -> list[dict]:
    """The union of the spans, in order; those that touch are one."""
    result: list[dict] = []
    for start, end in sorted(spans):
        if result and start <= result[-1]["end"]:
            result[-1]["end"] = max(result[-1]["end"], end)
        else:
            result.append({"start": start, "end": end})
    return result


def together() -> Callable[[Column], Column]:
    kind = to_arrow_type(schema_of(f"spans {SPANS}")["spans"].dataType)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            pairs = (((s["start"], s["end"]) for s in row) for row in batch.to_pylist())
            yield pa.array([united(row) for row in pairs], type=kind)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, returnType=schema_of(f"spans {SPANS}")["spans"].dataType)


def scanner(rows: DataFrame, words: int) -> Callable[[Column], Column]:
    """A column function that looks for the windows of one slice, which goes to the tasks by a broadcast."""
    held = [(row["item"], bytes(row["words"]).split()) for row in rows.collect()]  # bounded by slice_bytes
    shared = rows.sparkSession.sparkContext.broadcast(Windows(held, words))
    return text_function(lambda texts: shared.value.measure(texts), schema_of(RESULT))


def hits(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    words: int = WORDS,
    slice_bytes: int = SLICE_BYTES,
    carried: list[str] | None = None,
) -> DataFrame:
    """``key, n_words, n_hit, spans, items`` of each row, and the ``carried`` columns. Spans are of words, the end exclusive."""
    carried = carried or []
    source = benchmark.select(F.col(item).cast("string"), F.col(item_text))
    rows = checkpointed(source.mapInArrow(stretches(words), "item string, words binary").distinct())
    size = rows.select(F.sum(F.octet_length("words") + F.coalesce(F.octet_length("item"), F.lit(0)))).first()[0] or 0
    slices = -(-size // slice_bytes)
    if slices <= 1:
        look = scanner(rows, words)
        return docs.select(F.col(key), look(F.col(text)).alias("scan"), *carried).select(key, "scan.*", *carried)

    numbered, names = identified(docs)
    of = F.pmod(F.xxhash64("item", "words"), F.lit(slices))
    parts = []
    for n in range(slices):
        look = scanner(rows.filter(of == n), words)
        scanned = numbered.select(*names, look(F.col(text)).alias("scan")).filter("scan.n_hit > 0")
        parts.append(checkpointed(scanned.select(*names, "scan.spans", "scan.items").dropDuplicates(names)))
    found = reduce(DataFrame.unionAll, parts).groupBy(*names).agg(  # a row for each slice at most
        F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items")
    )
    found = found.select(*names, together()(F.col("spans")).alias("spans"), F.sort_array(F.array_distinct("items")).alias("items"))
    count = text_function(lambda texts: [{"n": len(words_of(t))} for t in texts], schema_of("n long"))
    whole = numbered.select(F.col(key), count(F.col(text))["n"].alias("n_words"), *names, *(c for c in carried if c not in names))
    lengths = F.transform("spans", lambda s: s["end"] - s["start"])
    return whole.join(found, names, "left").select(
        key,
        "n_words",
        F.coalesce(F.aggregate(lengths, F.lit(0).cast("long"), lambda a, b: a + b), F.lit(0).cast("long")).alias("n_hit"),
        *(F.coalesce(c, F.array().cast(kind)).alias(c) for c, kind in (("spans", SPANS), ("items", "array<string>"))),
        *carried,
    )


def cut() -> Callable[[Column], Column]:
    """A column function of (text, spans): the text without the bytes from a span's first word to its last."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts, spans = batch.field(0), batch.field(1).to_pylist()
            done = []
            for data, own in zip(chain.from_iterable(chunks(texts)), spans):
                places = [word.span() for word in WORD.finditer(data)] if own else []
                for span in reversed(own):
                    data = data[: places[span["start"]][0]] + data[places[span["end"] - 1][1] :]
                done.append(data)
            yield pa.array(done, pa.binary()).cast(pa.string())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, returnType="string")


def without(docs: DataFrame, benchmark: DataFrame, spans: bool = False, text: str = "text", **options) -> DataFrame:
    """The documents that hold no window; or, with ``spans``, all documents, with what windows cover cut out."""
    packed = F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row")
    rows = docs.select(packed, F.col(text).alias("text"))
    found = hits(rows, benchmark, "row", "text", carried=["text"], **options)
    if not spans:
        return found.filter("n_hit = 0").select("row.*")
    shorter = F.when(F.col("n_hit") > 0, cut()(F.struct("text", "spans"))).otherwise(F.col("text"))
    return found.select("row.*", shorter.alias("_cut")).select(
        *(F.col("_cut").alias(name) if name == text else F.col(f"`{name}`") for name in docs.columns)
    )
