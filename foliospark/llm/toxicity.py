"""Toxicity scores from a factorization machine over hashed terms.

A text is the set of its terms, each hashed to ``HASH_BITS`` bits: lower-cased words, their beginnings of ``BEGINNINGS``
characters, and once more those beginnings that two or more different words of the text share, since a telling stem is
repeated where a chance one stands alone. The machine has a weight and a vector for each term; a text's logit is the bias, the sum of its terms' weights, and
the sum over all pairs of its terms of the product of their vectors. The pairs carry what no sum of weights can: an
insult beside a group's name scores more than both alone. The pair sum costs one pass over the terms, not one
over pairs.

It is fitted with AdaGrad in batches on at most ``MOST_SAMPLED`` labelled rows, picked by a hash of their id where there
are more; a term must stand in ``least_texts`` of them. First the weights alone are fitted with a proximal step that
leaves all but the telling terms at zero. Then pairs are screened by their own gradient, the errors of the weights added up over
the texts that hold both terms: it is far from zero where a pair tells what its terms alone do not, however rare or neutral
they are. Terms of such pairs and terms with a weight get a vector; weights and vectors are then fitted together. So
the unseen and the incidental add nothing, and the terms of the sample bound the size of the model. Only the terms of a text are
inputs of its score.

Null and empty texts have no terms and score what the bias gives. Rows are scored one by one: repeated rows and null
ids each get their own result. Without any label of one of the two classes every text scores the share of toxic labels.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import schema_of, text_function
from foliospark.llm.licenses import words_of

HASH_BITS = 31
BEGINNINGS = range(3, 9)
SHARED = 0x2A5A5A5A  # marks the hash of a beginning that two words share
MOST_SAMPLED = 10_000
REMEMBERED = 200_000


@dataclass(frozen=True)
class Settings:
    factors: int = 8
    least_texts: int = 8
    linear_epochs: int = 20
    epochs: int = 20
    batch: int = 256
    step: float = 0.5
    l1: float = 3e-3  # proximal step on the weights, against incidental terms
    l2: float = 1e-4  # on the vectors
    spread: float = 0.01  # of the vectors at the start
    pair_error: float = 0.1  # texts whose error is smaller add nothing to a pair's gradient
    pair_share: float = 0.2  # terms in more of the texts make no pairs
    seed: int = 42


def hashed(term: bytes) -> int:
    return zlib.crc32(term) & ((1 << HASH_BITS) - 1)


def terms_of_word(word: bytes) -> tuple[list[int], list[int]]:
    """Hashes of the word and, marked, of its beginnings; and those the beginnings get where two words share them."""
    text = word.decode(errors="replace")
    begun = [hashed(b"^" + text[:size].encode()) for size in BEGINNINGS if size < len(text)]
    return [hashed(word), *begun], [term ^ SHARED for term in begun]


def terms_of(text: bytes) -> set[int]:
    return gathered(map(terms_of_word, set(words_of(text))))


def gathered(words: Iterable[tuple[list[int], list[int]]]) -> set[int]:
    """Each word's own terms, and the shared ones met a second time."""
    found: set[int] = set()
    once: set[int] = set()
    for own, shared in words:
        found.update(own)
        if shared:
            found.update(once.intersection(shared))
            once.update(shared)
    return found


@dataclass
class Machine:
    terms: np.ndarray  # hashes, ascending
    weights: np.ndarray
    vectors: np.ndarray
    bias: float

    def logits(self, places: np.ndarray, starts: np.ndarray, sizes: np.ndarray, factors: int = 1) -> np.ndarray:
        """``places`` of terms in the model, text after text. Without ``factors`` the pairs are left out."""
        linear = segment_sums(self.weights[places], starts, sizes)
        if not factors:
            return self.bias + linear
        vectors = self.vectors[places]
        total = segment_sums(vectors, starts, sizes)
        squares = segment_sums((vectors * vectors).sum(axis=1), starts, sizes)
        return self.bias + linear + 0.5 * ((total * total).sum(axis=1) - squares)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return probability(self.logits(*flattened([self.places(text) for text in texts])))

    def places(self, text: bytes) -> set[int]:
        known = self.known
        words = set(words_of(text))
        for word in words.difference(known):
            own, shared = ([self.index[t] for t in terms if t in self.index] for terms in terms_of_word(word))
            known[word] = (own, shared) if own or shared else None
        found = gathered(filter(None, map(known.__getitem__, words)))
        if len(known) > REMEMBERED:
            known.clear()
        return found

    @cached_property
    def index(self) -> dict[int, int]:
        return {term: place for place, term in enumerate(self.terms.tolist())}

    @cached_property
    def known(self) -> dict[bytes, tuple[list[int], list[int]] | None]:
        """Places of the terms of words met so far, in this task; None for words without any."""
        return {}


def probability(logits: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def known_places(terms: np.ndarray, text: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(terms, text), max(len(terms) - 1, 0))
    return at[terms[at] == text] if len(terms) else at[:0]


def flattened(found: list[set[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    places = np.fromiter(chain.from_iterable(map(sorted, found)), np.int64, int(sizes.sum()))
    return places, np.cumsum(sizes) - sizes, sizes


def segment_sums(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[starts + sizes] - total[starts]


def fit(features: list[np.ndarray], labels: np.ndarray, settings: Settings = Settings()) -> Machine:
    """``features``: the distinct hashed terms of each text."""
    terms, texts = np.unique(np.concatenate([np.empty(0, np.int32), *features]), return_counts=True)
    terms = terms[texts >= settings.least_texts]
    share = (labels.sum() + 1) / (len(labels) + 2)
    bias = float(np.log(share / (1 - share)))
    machine = Machine(terms, np.zeros(len(terms)), np.zeros((len(terms), settings.factors)), bias)
    if labels.min() != labels.max():
        random = np.random.default_rng(settings.seed)
        train(machine, features, labels, settings, random, settings.linear_epochs, factors=0)
    telling = machine.weights != 0
    if len(terms) and labels.min() != labels.max():
        telling[pair_terms(machine, features, labels, settings)] = True
    machine = Machine(terms[telling], machine.weights[telling], machine.vectors[telling], machine.bias)
    if len(machine.terms):
        machine.vectors[:] = random.normal(0, settings.spread, machine.vectors.shape)
        train(machine, features, labels, settings, random, settings.epochs, settings.factors)
    return machine


GATHERED = 1 << 20


def pair_terms(machine: Machine, features: list[np.ndarray], labels: np.ndarray, settings: Settings) -> np.ndarray:
    """Places of the terms of all pairs whose gradient stands out.

    A gradient stands out if it is as large, over its own spread, as chance makes hardly any of so many pairs. A sum of n errors
    is at most the root of n times their spread, so the bar's square is a number of texts that a pair must share, and
    terms in fewer of them are left out first. The rest is added up exactly, the pairs of one term at a time, so that no
    more is held than a number for each term and ``GATHERED`` entries of texts.
    """
    rows = [known_places(machine.terms, text).astype(np.int32) for text in features]
    error, texts = np.zeros(len(rows)), np.zeros(len(machine.terms), np.int64)
    for first in range(0, len(rows), settings.batch):
        some = slice(first, first + settings.batch)
        sizes = np.fromiter(map(len, rows[some]), np.int64)
        places = np.concatenate(rows[some])
        error[some] = labels[some] - probability(machine.logits(places, np.cumsum(sizes) - sizes, sizes, 0))
        texts += np.bincount(places, minlength=len(texts))
    rare = texts <= max(settings.pair_share * len(rows), settings.least_texts)
    wrong = np.flatnonzero(np.abs(error) >= settings.pair_error)
    rows, error = [rows[i][rare[rows[i]]] for i in wrong], error[wrong]
    met = sum(len(row) * (len(row) - 1) // 2 for row in rows)
    bar = (2 * np.log(max(2, min(met, len(machine.terms) ** 2 // 2)))) ** 0.5
    least = max(settings.least_texts, int(np.ceil(bar**2)))
    texts[:] = 0
    for row in rows:
        texts[row] += 1
    kept = np.flatnonzero(texts >= least)
    number = np.full(len(texts), -1, np.int32)
    number[kept] = np.arange(len(kept), dtype=np.int32)
    rows = [numbers[numbers >= 0] for numbers in (number[row] for row in rows)]
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    flat = np.concatenate([np.empty(0, np.int32), *rows])
    holders = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)[np.argsort(flat, kind="stable")]
    ends = np.cumsum(np.bincount(flat, minlength=len(kept)))
    found = np.zeros(len(kept), bool)
    for term in range(len(kept)):
        held = holders[ends[term] - texts[kept[term]] : ends[term]]
        runs = np.split(held, np.flatnonzero(np.diff(np.cumsum(sizes[held]) // GATHERED)) + 1)
        shared = sum(np.bincount(np.concatenate([rows[i] for i in run]), minlength=len(kept)) for run in runs)
        often = shared >= least
        often[: term + 1] = False
        if not often.any():
            continue
        gradient, square = np.zeros(len(kept)), np.zeros(len(kept))
        for run in runs:
            others = np.concatenate([rows[i] for i in run])
            each = np.repeat(error[run], sizes[run])[often[others]]
            others = others[often[others]]
            gradient += np.bincount(others, each, len(kept))
            square += np.bincount(others, each * each, len(kept))
        strong = often & (np.abs(gradient) >= bar * np.sqrt(square))
        found |= strong
        found[term] |= strong.any()
    return kept[found]


def train(
    machine: Machine,
    features: list[np.ndarray],
    labels: np.ndarray,
    settings: Settings,
    random: np.random.Generator,
    epochs: int,
    factors: int,
) -> None:
    """Fit the weights, and the vectors if there are ``factors``."""
    rows = [known_places(machine.terms, text) for text in features]
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    power_w, power_v, power_b = np.full(len(machine.terms), 1e-3), np.full(len(machine.terms), 1e-3), 1e-3
    for _ in range(epochs):
        order = random.permutation(len(rows))
        for first in range(0, len(order), settings.batch):
            chosen = order[first : first + settings.batch]
            n = sizes[chosen]
            places = np.concatenate([rows[i] for i in chosen])
            starts = np.cumsum(n) - n
            error = probability(machine.logits(places, starts, n, factors)) - labels[chosen]
            each = np.repeat(error, n) / len(chosen)
            used, back = np.unique(places, return_inverse=True)
            grad = np.bincount(back, each, len(used))
            power_w[used] += grad**2
            rate = settings.step / np.sqrt(power_w[used])
            weights = machine.weights[used] - rate * grad
            shrink = 0.0 if factors else rate * settings.l1
            machine.weights[used] = np.sign(weights) * np.maximum(np.abs(weights) - shrink, 0)
            if factors:
                vectors = machine.vectors[places]
                pull = each[:, None] * (np.repeat(segment_sums(vectors, starts, n), n, axis=0) - vectors)
                grads = np.stack([np.bincount(back, pull[:, k], len(used)) for k in range(factors)], axis=1)
                grads += settings.l2 * machine.vectors[used]
                power_v[used] += (grads**2).mean(axis=1)
                machine.vectors[used] -= 0.2 * settings.step / np.sqrt(power_v[used])[:, None] * grads
            slope = float(error.mean())
            power_b += slope**2
            machine.bias -= settings.step / np.sqrt(power_b) * slope


def sampled_labels(labels: DataFrame, key: str, label: str, most: int) -> DataFrame:
    """Key and label of at most ``most`` labelled rows: all, or those whose key's hash is in a first part of its range."""
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(key).agg(F.max(F.col(label)).cast("double").alias("target"))
    rows = known.count()
    if rows <= most:
        return known
    parts = 1_000_000
    return known.filter(F.pmod(F.xxhash64(F.col(key)), F.lit(parts)) < int(0.95 * parts * most / rows)).limit(most)


def learn(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    most: int = MOST_SAMPLED,
    settings: Settings = Settings(),
) -> Machine:
    """Fit on the labelled rows among ``docs``: their hashed terms, of ``most`` rows at most, come to the driver."""
    chosen = F.broadcast(sampled_labels(labels, key, label, most))  # never over `most` rows of a key and a number
    extract = text_function(
        lambda texts: [{"terms": sorted(terms_of(text))} for text in texts], schema_of("terms array<int>")
    )
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(
        chosen.withColumnRenamed(key, "key"), "key"
    )
    found = rows.select("key", "target", F.xxhash64("key").alias("order"), extract("text")["terms"].alias("terms"))
    table = found.limit(most).toArrow().sort_by([("order", "ascending"), ("key", "ascending")])
    lists = table["terms"].combine_chunks()
    values, edges = lists.flatten().to_numpy(), np.r_[0, np.cumsum(lists.value_lengths().to_numpy())]
    features = [values[a:b] for a, b in zip(edges, edges[1:])]
    targets = table["target"].to_numpy()
    if not len(targets):
        return Machine(np.empty(0, np.int32), np.empty(0), np.empty((0, settings.factors)), 0.0)
    return fit(features, targets, settings)


def score(machine: Machine) -> Callable[[str | Column], Column]:
    """A column function: the probability of label 1 for a text."""
    function = text_function(
        lambda texts: [{"score": float(p)} for p in machine.scores(texts)], schema_of("score double")
    )
    return lambda text: function(text)["score"]
