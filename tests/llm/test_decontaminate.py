"""Benchmark windows in documents against plain comparison of every window."""

from __future__ import annotations

import re
from random import Random

import pytest

from foliospark.llm import decontaminate
from tests.llm.conftest import SCHEMA

ITEMS = "item_id long, text string, spans string, n_hit long"


def words_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_hits(text, items, size=10):
    words, hit, ids = words_of(text), set(), set()
    for item, own in items:
        item_words = words_of(own)
        length = min(size, len(item_words))
        for start in range(len(item_words) - length + 1 if item_words else 0):
            window = item_words[start : start + length]
            for at in range(len(words) - length + 1):
                if words[at : at + length] == window:
                    hit |= set(range(at, at + length))
                    ids.add(item)
    return len(words), hit, sorted(str(i) for i in ids if i is not None)


def made(seed=3):
    random = Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["é", "naïve", "X"]
    text = lambda n: " ".join(random.choice(vocabulary) for _ in range(n))
    items = [(n, text(random.choice([1, 3, 9, 10, 11, 30]) if n % 5 else 25)) for n in range(30)]
    items = [(n, t) for n, t in items if len(words_of(t)) != 1] + [(1000, "unseenword"), (None, text(14)), (7, text(12))]
    items += [(2000, items[0][1]), (3000, None), (4000, " .- "), items[1]]
    rows = []
    for n in range(80):
        parts = [text(random.randrange(60))]
        for _ in range(random.randrange(3)):
            own = words_of(random.choice(items)[1])
            a = random.randrange(max(1, len(own) - 3))
            parts.append("; ".join(own[a : a + random.randrange(4, 30)]).upper())
            parts.append(text(random.randrange(20)))
        rows.append((n, " ".join(parts)))
    rows += [(500, None), (501, ""), (502, "unseenword"), (None, items[0][1]), rows[0], rows[0]]
    return rows, items


def frames(spark, rows, items):
    docs = spark.createDataFrame([(n, t, "en", "s", 0) for n, t in rows], SCHEMA)
    return docs, spark.createDataFrame([(n, t, "", 0) for n, t in items], ITEMS)


@pytest.mark.parametrize("slice_bytes", [1 << 24, 400])
@pytest.mark.parametrize("stretch", [10_000, 7])
def test_hits_equal_all_windows(spark, monkeypatch, slice_bytes, stretch):
    monkeypatch.setattr(decontaminate, "STRETCH_WORDS", stretch)
    rows, items = made()
    docs, benchmark = frames(spark, rows, items)
    for clash in ("scan", "n_words", "items", "spans", "item", "words", "_row1"):
        docs = docs.withColumn(clash, docs.n_chars)
    found = decontaminate.hits(docs, benchmark, slice_bytes=slice_bytes).collect()
    assert len(found) == len(rows)
    expected = sorted((str(n), *plain_hits(t, items)) for n, t in rows)
    actual = sorted(
        (str(r.doc_id), r.n_words, {w for s in r.spans for w in range(s.start, s.end)}, r["items"]) for r in found
    )
    assert actual == expected
    assert all(r.n_hit == sum(s.end - s.start for s in r.spans) for r in found)
    assert 0 < sum(r.n_hit > 0 for r in found) < len(found)


def test_windows_with_equal_hashes_get_another_seed(monkeypatch):
    seeds = []
    real = decontaminate.np.random.default_rng

    class Poor:
        def integers(self, low, high, size, *rest, **options):
            return decontaminate.np.ones(size, decontaminate.np.uint64)

    def generator(seed):
        seeds.append(seed)
        return Poor() if seed == 1 else real(seed)

    monkeypatch.setattr(decontaminate.np.random, "default_rng", generator)
    windows = decontaminate.Windows([("1", [b"a", b"b"]), ("2", [b"b", b"a"])], 10)
    assert seeds == [1, 2]
    assert [r["items"] for r in windows.measure([b"a b", b"b a b", b"a a"])] == [["1"], ["1", "2"], []]


@pytest.mark.parametrize("slice_bytes", [1 << 24, 400])
def test_documents_or_spans_go(spark, slice_bytes):
    rows, items = made(4)
    docs, benchmark = frames(spark, rows, items)
    kept = decontaminate.without(docs, benchmark, slice_bytes=slice_bytes)
    assert kept.columns == docs.columns
    clean = sorted(str(n) for n, t in rows if not plain_hits(t, items)[1])
    assert sorted(str(r.doc_id) for r in kept.collect()) == clean
    shorter = decontaminate.without(docs, benchmark, spans=True, slice_bytes=slice_bytes)
    assert shorter.columns == docs.columns and shorter.count() == len(rows)
    result = sorted((str(r.doc_id), words_of(r.text)) for r in shorter.collect())
    wanted = []
    for n, text in rows:
        _, hit, _ = plain_hits(text, items)
        wanted.append((str(n), [w for at, w in enumerate(words_of(text)) if at not in hit]))
    assert result == sorted(wanted)
    texts = {r.doc_id: r.text for r in shorter.collect()}
    assert all(texts[n] == t for n, t in rows if not plain_hits(t, items)[1])


def test_decontamination_takes_any_rows(spark, docs, empty):
    items = [(1, "a b c d e f g h i j k"), (2, "word word word word word word word word word word"), (3, "café")]
    benchmark = spark.createDataFrame([(n, t, "", 0) for n, t in items], ITEMS)
    found = decontaminate.hits(docs, benchmark).collect()
    wanted = sorted((str(r.doc_id), len(hit), ids) for r in docs.collect() for _, hit, ids in [plain_hits(r.text[:500] if r.text else None, items)])
    long = {10, 11, 110, 111}
    assert sorted((str(r.doc_id), r.n_hit, r["items"]) for r in found if r.doc_id not in long) == [w for w in wanted if w[0] not in map(str, long)]
    assert all(r.n_hit == 30_000 and r["items"] == ["2"] for r in found if r.doc_id in long)
    assert decontaminate.hits(empty, benchmark).collect() == []
    assert all(r.n_hit == 0 and r["items"] == [] for r in decontaminate.hits(docs, benchmark.limit(0)).collect())
    assert decontaminate.without(docs, benchmark).columns == docs.columns
