"""License scan: a set-similarity join of text blocks with license templates.

A block is every run of ``2 * stride`` words, one starting at each multiple of ``stride``, where stride is the length
of the longest template; so a notice lies whole in a block wherever it stands and however its lines break. A
block meets a template if it holds at least ``threshold`` of the template's distinct words. The join is exact: words
are ordered from the rarest in the whole corpus to the most frequent, a template is looked up by the prefix of that
order that any partner must share, and the length and the positions of the first shared word bound what the overlap
can still reach before it is counted.

Partners are then verified on the block's words in their order: the words of a short notice must follow each other but for
``FILLERS``; of a longer template some ``2 * length`` words in a row must hold the threshold; and ``cc-by`` needs an
"attribution" that its non-commercial, share-alike and no-derivatives forms do not go on from.

Words no template has cannot add to an overlap, so only the templates' words are ordered; their number is the size of
the one thing that tasks get from the driver.

Null and empty texts have no words, no block and score 0. Rows are judged one by one: repeated rows and null ids
each get their own result. Only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import chunks, schema_of, text_function

# Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Sentences and notices by which public licenses are recognised, with their labels.
TEMPLATES = (
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation the "
        "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions",
    ),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    (
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
        "the license you may obtain a copy of the license at",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met redistributions of source code must retain the above copyright notice this list of "
        "conditions and the following disclaimer",
    ),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version 3 of the license or at your option any later "
        "version",
    ),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "no rights reserved released under the cc0 public domain dedication"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("no-warranty", "the software is provided as is without warranty of any kind express or implied"),
    # Short notices: their words stand one after the other.
    ("reserved", "all rights reserved"),
    ("mit", "mit license"),
    ("mit", "spdx license identifier mit"),
    ("apache-2.0", "apache license 2 0"),
    ("apache-2.0", "spdx license identifier apache 2"),
    ("bsd", "bsd license"),
    ("bsd", "bsd 2 clause"),
    ("bsd", "bsd 3 clause"),
    ("isc", "isc license"),
    ("isc", "spdx license identifier isc"),
    ("gpl", "spdx license identifier gpl"),
    ("mpl-2.0", "mozilla public license 2"),
    ("mpl-2.0", "spdx license identifier mpl 2"),
    ("cc-by", "creative commons attribution license"),
    ("cc-by", "creative commons attribution 4 0"),
    ("cc-by", "creative commons attribution 3 0"),
    ("cc-by-nc", "cc by nc"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by-sa", "cc by sa"),
    ("cc-by-sa", "cc by nc sa"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("cc-by-sa", "creative commons attribution noncommercial sharealike"),
    ("cc-by-nd", "cc by nd"),
    ("cc-by-nd", "cc by nc nd"),
    ("cc-by-nd", "creative commons attribution noderivatives"),
    ("cc-by-nd", "creative commons attribution noncommercial noderivatives"),
    ("cc0", "released under cc0"),
    ("cc0", "licensed under cc0"),
    ("cc0", "cc0 1 0"),
    ("unlicense", "released under unlicense"),
    ("unlicense", "licensed under unlicense"),
)
SHORT = 6  # words of a notice whose words must follow each other
FILLERS = ("the", "a", "an", "of", "terms", "version", "v")  # words that may stand between those
#: A word that another license's name goes on with: ``cc-by`` is not met where it follows this word everywhere.
NAME_END, VARIANTS = "attribution", ("noncommercial", "sharealike", "noderivatives", "noderivs")
THRESHOLD = 0.8

#: Lower-cases A-Z; any other byte below 0x80 that is no letter or digit becomes a space.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, blocks array<struct<block: long, label: string, containment: double>>"
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


@dataclass(frozen=True)
class Templates:
    """Templates as sets of words, the threshold as the least overlap of each."""

    labels: tuple[str, ...]
    lists: tuple[list[bytes], ...]
    words: tuple[frozenset[bytes], ...]
    vocabulary: tuple[bytes, ...]
    least: tuple[int, ...]
    stride: int

    @classmethod
    def of(cls, templates: tuple[tuple[str, str], ...], threshold: float) -> Templates:
        split = [words_of(text.encode()) for _, text in templates]
        sets = tuple(frozenset(words) for words in split)
        return cls(
            tuple(label for label, _ in templates),
            tuple(split),
            sets,
            tuple(sorted(frozenset().union(*sets))),
            tuple(
                len(words) if len(own) <= SHORT else ceil(threshold * len(words) - 1e-9) for own, words in zip(split, sets)
            ),
            max(map(len, split)),
        )


def block_words(texts: list[list[bytes]], templates: Templates) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, block and number (in the vocabulary) of each distinct template word of each block."""
    number = {word: i for i, word in enumerate(templates.vocabulary)}
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    found = np.fromiter(
        map(number.get, chain.from_iterable(texts), repeat(-1)), np.int32, int(sizes.sum())
    )
    at = np.flatnonzero(found >= 0)
    ends = np.cumsum(sizes)
    text = np.searchsorted(ends, at, side="right")
    block = (at - (ends - sizes)[text]) // templates.stride
    word = found[at].astype(np.int64)
    earlier = block > 0  # the block before reaches into this one
    text, block = np.concatenate([text, text[earlier]]), np.concatenate([block, block[earlier] - 1])
    word = np.concatenate([word, word[earlier]])
    if not len(word):
        return text, block, word
    most = int(block.max()) + 1
    key = np.unique((text * most + block) * len(number) + word)
    place, word = np.divmod(key, len(number))
    return place // most, place % most, word


def word_frequencies(texts: DataFrame, templates: Templates) -> DataFrame:
    """In how many blocks of the whole corpus each template word stands: at most one row for each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(templates.vocabulary), np.int64)
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                _, _, word = block_words([words_of(text) for text in chunk], templates)
                total += np.bincount(word, minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["word", "blocks"])

    counts = texts.mapInArrow(count, "word long, blocks long")
    return counts.groupBy("word").agg(F.sum("blocks").alias("blocks"))


def phrase_places(words: list[bytes], phrases: dict[str, str]) -> list[tuple[int, str]]:
    """Word number and label of each place of a phrase, overlapping ones too."""
    line, places = b"", []
    for phrase, label in phrases.items():
        parts = phrase.encode().split()
        if not all(part in words for part in parts):
            continue
        line = line or b" " + b" ".join(words) + b" "
        sought = b" " + phrase.encode() + b" "
        at = line.find(sought)
        while at >= 0:
            places.append((line.count(b" ", 0, at), label))
            at = line.find(sought, at + 1)
    return places


class BlockJoin:
    """The join of blocks with templates, for one order of the words."""

    def __init__(self, templates: Templates, frequency: dict[int, int], phrases: dict[str, str]):
        order = sorted(range(len(templates.vocabulary)), key=lambda i: (frequency.get(i, 0), i))
        self.templates, self.phrases = templates, phrases
        self.lists = templates.lists
        self.fillers = {word.encode() for word in FILLERS}
        self.rank = np.argsort(np.array(order, np.int64))
        number = {word: i for i, word in enumerate(templates.vocabulary)}
        self.sorted = [sorted(int(self.rank[number[w]]) for w in words) for words in templates.words]
        self.index: dict[int, list[tuple[int, int]]] = {}
        for t, ranks in enumerate(self.sorted):
            for place in range(len(ranks) - templates.least[t] + 1):
                self.index.setdefault(ranks[place], []).append((t, place))
        self.indexed = np.zeros(len(order), bool)
        self.indexed[list(self.index)] = True

    def partners(self, block: list[int]) -> Iterator[tuple[int, float]]:
        """Templates that a block, its words' ranks ascending, meets; with the containment."""
        met: set[int] = set()
        held = set(block)
        for j, rank in enumerate(block):
            for t, i in self.index.get(rank, ()):
                if t in met:
                    continue
                met.add(t)  # this is their first common word
                ranks, least = self.sorted[t], self.templates.least[t]
                if len(block) < least or 1 + min(len(ranks) - i, len(block) - j) - 1 < least:
                    continue
                shared = sum(r in held for r in ranks[i:])
                if shared >= least:
                    yield t, shared / len(ranks)

    def verified(self, t: int, words: list[bytes]) -> bool:
        """Whether the words of a block hold the template in its place, not only its words."""
        sought, least = self.lists[t], self.templates.least[t]
        if self.templates.labels[t] == "cc-by" and NAME_END.encode() in sought:
            following = [b for a, b in zip(words, [*words[1:], b""]) if a == NAME_END.encode()]
            if all(word.decode() in VARIANTS for word in following):
                return False
        if len(sought) <= SHORT:
            line = b" ".join(word for word in words if word not in self.fillers)
            return b" " + b" ".join(sought) + b" " in b" " + line + b" "
        span, held = 2 * len(sought), set(sought)
        at = [i for i, word in enumerate(words) if word in held]
        return any(len({words[j] for j in at if i <= j < i + span}) >= least for i in at)

    def measure(self, texts: list[bytes]) -> list[dict]:
        split = [words_of(text) for text in texts]
        met: dict[int, list[tuple[int, str, float]]] = {}
        text, block, word = block_words(split, self.templates)
        if len(word):
            rank = self.rank[word]
            order = np.lexsort((rank, block, text))
            text, block, rank = text[order], block[order], rank[order]
            starts = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (block[1:] != block[:-1])])
            ends = np.r_[starts[1:], len(text)]
            hits = np.add.reduceat(self.indexed[rank].astype(np.int64), starts) > 0
            for a, b in zip(starts[hits], ends[hits]):
                first = int(block[a]) * self.templates.stride
                words = split[int(text[a])][first : first + 2 * self.templates.stride]
                for t, containment in self.partners(rank[a:b].tolist()):
                    if not self.verified(t, words):
                        continue
                    label = self.templates.labels[t]
                    met.setdefault(int(text[a]), []).append((int(block[a]), label, containment))
        return [self.record(words, met.get(i, [])) for i, words in enumerate(split)]

    def record(self, words: list[bytes], blocks: list[tuple[int, str, float]]) -> dict:
        places = phrase_places(words, self.phrases)
        base = {label for _, label in places}
        return {
            "n_words": len(words),
            "n_base": len(places),
            "first_word": min((at for at, _ in places), default=None),
            "last_word": max((at for at, _ in places), default=None),
            "base_labels": ",".join(sorted(base)),
            "labels": ",".join(sorted(base | {label for _, label, _ in blocks})),
            "score": 1.0 if places else max((share for _, _, share in blocks), default=0.0),
            "blocks": [{"block": n, "label": label, "containment": share} for n, label, share in blocks],
        }


def scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: float = THRESHOLD,
    phrases: dict[str, str] = PHRASES,
) -> DataFrame:
    """Key, phrase places and labels of each row, and each block that meets a template with its containment."""
    sets = Templates.of(templates, threshold)
    counted = word_frequencies(docs.select(text), sets).collect()  # a row for each word of the templates
    join = BlockJoin(sets, {row["word"]: row["blocks"] for row in counted}, phrases)
    judge = text_function(join.measure, schema_of(RESULT))
    return docs.select(F.col(key), judge(F.col(text)).alias("scan")).select(key, "scan.*")
