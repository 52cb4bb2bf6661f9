"""Quality rules on repetition: maximal repeated word sequences from a suffix array.

The texts of an Arrow chunk are sorted as one array of word suffixes by prefix doubling, each text apart. Where
neighbours share a prefix, the length of that prefix (the LCP) is the depth of an interval of equal beginnings; the
repeats that cannot be extended to either side are the maximal repeats. The union of their spans gives the share of
a text that is repeated, the deepest interval the longest repeat. Base measures of words, symbols and lines come along.

A text is kept unless it has too few words, too many words in repeated 5-word windows, too large a share of words in
maximal repeats of ``repeat_words`` words or more, or a repeat longer than ``longest_words``.

Null and empty texts have no words and fail. Rows are judged one by one: repeated rows and null ids each get their
own result. Texts are never cut; one text of any length is sorted whole in its task. An empty table gives no rows. Only the key
and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import schema_of, text_function

WHITE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
LATER_BYTES = bytes(range(0x80, 0xC0))  # of a UTF-8 character
WINDOW = 5
RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, n_maximal_words long, longest_repeat long"
)


@dataclass(frozen=True)
class Limits:
    """Fixed by the base rules: ``least_words``, ``repeat_pct``. Of the method: the other three.

    They are drawn from ``labels.quality``: repeats of three words, which the base's windows of five miss where short lines
    come again and again, cover at most 22 words of a hundred in documents of quality 1.
    """

    least_words: int = 10
    repeat_pct: int = 20
    repeat_words: int = 3
    maximal_pct: int = 25
    longest_words: int = 50


def repeated_prefixes(word: np.ndarray, text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each suffix, the most words it shares at its start with another suffix of its text.

    ``word`` numbers the words, ``text`` and ``ends`` give each place its text and that text's end.
    """
    n = len(word)
    if not n:
        return np.zeros(0, np.int64)
    first = text * (int(word.max()) + 1) + word
    order = np.argsort(first, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = group_starts(first[order], np.arange(n))
    ranks, length = [rank.copy()], 1
    active = shared_slots(rank[order])
    while len(active):
        at = order[active]
        after = at + length
        following = np.where(after < ends[at], rank[np.minimum(after, n - 1)], -1)
        key = rank[at] * (n + 1) + following + 1
        sort = np.argsort(key, kind="stable")
        at = at[sort]
        order[active] = at
        starts = group_starts(key[sort], active)
        rank[at] = starts
        active = active[shared_slots(starts)]
        length *= 2
        if len(active):
            ranks.append(rank.copy())
    return longest_shared(order, ranks, ends)


def group_starts(values: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """For each of the sorted values, the slot at which its run of equals begins."""
    new = np.r_[True, values[1:] != values[:-1]]
    return slots[np.maximum.accumulate(np.where(new, np.arange(len(values)), 0))]


def shared_slots(starts: np.ndarray) -> np.ndarray:
    """Places in a sorted array whose run of equals has more than one member."""
    same = starts[1:] == starts[:-1]
    return np.flatnonzero(np.r_[False, same] | np.r_[same, False])


def longest_shared(order: np.ndarray, ranks: list[np.ndarray], ends: np.ndarray) -> np.ndarray:
    """The larger LCP of each suffix with its neighbours. ``ranks[k]`` is equal where 2**k words are."""
    n = len(order)
    left, right = order[:-1], order[1:]
    pairs = np.flatnonzero(ranks[0][left] == ranks[0][right])
    a, b = left[pairs].copy(), right[pairs].copy()
    shared = np.zeros(len(pairs), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        # Only ranks of shared prefixes are exact at a level; others are unequal at it and above.
        inside = (a < ends[left[pairs]]) & (b < ends[right[pairs]])
        same = inside.copy()
        same[inside] = ranks[k][a[inside]] == ranks[k][b[inside]]
        step = 1 << k
        shared[same] += step
        a[same] += step
        b[same] += step
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, left[pairs], shared)
    np.maximum.at(longest, right[pairs], shared)
    return longest


def covered(longest: np.ndarray, least: int, span: int | None = None) -> np.ndarray:
    """Which words lie in repeats of ``least`` words or more; ``span`` takes only so many words of each."""
    starts = np.flatnonzero(longest >= least)
    if span is None:  # a repeat that begins one word earlier and ends no sooner contains this one
        earlier = np.r_[0, longest[:-1]]
        starts = starts[earlier[starts] <= longest[starts]]
    sizes = longest[starts] if span is None else span
    edge = np.zeros(len(longest) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + sizes, -1)
    return np.cumsum(edge[:-1]) > 0


def repeated_lines(text: bytes) -> int:
    lines = text.split(b"\n")
    seen: set[bytes] = set()
    count = 0
    if len(set(lines)) < len(lines):
        for line in lines:
            count += line in seen and bool(line.strip(WHITE))
            seen.add(line)
    return count


def per_text(marked: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(marked, dtype=np.int64)]
    return total[starts + sizes] - total[starts]


def measure(texts: list[bytes], limits: Limits) -> list[dict]:
    split = [text.split() for text in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    stops = np.cumsum(sizes)
    starts = stops - sizes
    number: dict[bytes, int] = {}
    flat = [number.setdefault(word, len(number)) for word in chain.from_iterable(split)]
    owner = np.repeat(np.arange(len(split)), sizes)
    longest = repeated_prefixes(np.array(flat, np.int64), owner, np.repeat(stops, sizes))
    in_windows = per_text(covered(longest, WINDOW, WINDOW), starts, sizes)
    in_repeats = per_text(covered(longest, limits.repeat_words), starts, sizes)
    deepest = np.zeros(len(split), np.int64)
    np.maximum.at(deepest, owner, longest)
    records = []
    for text, n, windows, repeats, deep in zip(
        texts, sizes.tolist(), in_windows.tolist(), in_repeats.tolist(), deepest.tolist()
    ):
        failed = n < limits.least_words or 100 * windows > limits.repeat_pct * n
        records.append(
            {
                "n_words": n,
                "word_chars": len(text.translate(None, WHITE + LATER_BYTES)),
                "n_symbols": len(text) - len(text.translate(None, SYMBOLS)),
                "n_dup_lines": repeated_lines(text),
                "n_repeat_words": windows,
                "base_failed": failed,
                "kept": not failed and 100 * repeats <= limits.maximal_pct * n and deep <= limits.longest_words,
                "n_maximal_words": repeats,
                "longest_repeat": deep,
            }
        )
    return records


def quality(text: str | Column, limits: Limits = Limits()) -> Column:
    """A struct of the measures and the verdict for a text column."""
    return text_function(lambda texts: measure(texts, limits), schema_of(RESULT))(text)


def rules(docs: DataFrame, key: str = "doc_id", text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """Key, measures and verdict of each row."""
    return docs.select(F.col(key), quality(F.col(text), limits).alias("rules")).select(key, "rules.*")


def kept_rows(docs: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The rows whose text passes, with the columns they came with."""
    mark = "_rules"
    while mark in docs.columns:
        mark += "_"
    judged = docs.withColumn(mark, quality(F.col(text), limits))
    return judged.filter(F.col(mark)["kept"]).drop(mark)
