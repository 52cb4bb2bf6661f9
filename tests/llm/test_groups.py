"""Operators that look at many rows, against plain code over the same rows."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from random import Random

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from foliospark.llm import content_sort, mixing, pieces, queries, sharding, simhash, url_rules
from foliospark.llm.common import documents, new_path
from foliospark.llm.oracle import ORACLE
from tests.llm.conftest import SCHEMA

FOLDER = "/root/testdata/sf0.001"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    result = connection.execute(ORACLE[name])
    columns = [column[0] for column in result.description]
    frame = queries.registry()[name](spark, FOLDER)
    assert sorted(frame.columns) == sorted(columns)
    assert Counter(map(tuple, frame.select(*columns).collect())) == Counter(result.fetchall())


# Sharding


def check_shards(rows, shards, count):
    slots = defaultdict(list)
    for row in rows:
        slots[row.shard].append(row.slot)
    assert sum(map(len, slots.values())) == count
    sizes = [len(slots[shard]) for shard in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(places) == list(range(len(places))) for places in slots.values())


@pytest.mark.parametrize("bucket_bytes", [1 << 10, 1 << 16, 1 << 30])
@pytest.mark.parametrize("shards", [1, 7, 16])
def test_shards_hold_each_record_once(spark, bucket_bytes, shards):
    docs = documents(spark, FOLDER)
    written = sharding.shard(docs, bucket_bytes=bucket_bytes, shards=shards)
    rows = written.collect()
    check_shards(rows, shards, docs.count())
    assert Counter(row[:5] for row in rows) == Counter(map(tuple, docs.collect()))


def test_shards_agree_between_runs_and_partitions(spark):
    docs = documents(spark, FOLDER)
    one, two = (sharding.shard(frame, bucket_bytes=50_000) for frame in (docs, docs.repartition(5)))
    assert Counter(one.collect()) == Counter(two.collect())
    other = sharding.shard(docs, bucket_bytes=50_000, seed=1)
    assert Counter(one.collect()) != Counter(other.collect())


def test_places_are_uniform(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    rows = sharding.shard(docs, bucket_bytes=2000, shards=8).collect()
    counts = np.zeros((8, 8))
    for row in rows:
        counts[row.doc_id // 500, row.shard] += 1
    expected = 4000 / 64
    assert ((counts - expected) ** 2 / expected).sum() < 100  # 49 degrees of freedom: beyond this one in 20,000


def test_sharding_takes_any_rows(spark, docs, empty):
    written = sharding.shard(docs)
    check_shards(written.collect(), 16, docs.count())
    assert "bucket" not in written.columns and {"shard", "slot", "key"} <= set(written.columns)
    assert sharding.shard(empty).count() == 0


def test_sharding_query(spark):
    texts = {r.doc_id: r.text for r in documents(spark, FOLDER).collect()}
    for row in queries.sharding_two_pass(spark, FOLDER).collect():
        data = texts[row.doc_id].encode()
        assert (row["size"], row.text_crc32) == (len(data) + 1, zlib.crc32(data))


# Mixing


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [None] * (None in sizes)
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = [n for n in names if n not in capped]
        left = total - sum(capped.values())
        share = {n: left * weight[n] / sum(weight[m] for m in rest) for n in rest}
        over = [n for n in rest if share[n] > most * sizes[n]]
        if not over:
            return {**capped, **share}
        capped.update({n: most * sizes[n] for n in over})


@given(st.dictionaries(st.one_of(st.none(), st.sampled_from("abcdefghéz")), st.integers(0, 500), min_size=1))
@hypothesis_settings(max_examples=25, deadline=None)
def test_targets_equal_the_rounds_of_resharing(spark, sizes):
    rows = [(name, size, 1) for name, size in sizes.items()]
    frame = spark.createDataFrame(rows, "source string, source_size long, rows long")
    found = {row.source: row.target for row in mixing.source_targets(frame).collect()}
    wanted = plain_targets(sizes)
    assert found.keys() == wanted.keys()
    assert all(abs(found[name] - wanted[name]) < 1e-6 for name in wanted)


@given(
    st.lists(st.tuples(st.integers(1, 1000), st.floats(0.001, 0.999), st.floats(0, 0.999)), max_size=60),
)
def test_rounding_keeps_the_words(rows):
    sizes, parts, draws = ([row[i] for row in rows] for i in range(3))
    decided, held = mixing.decide(sizes, parts, draws)
    assert all(part in (0, 1) for i, part in enumerate(decided) if i != held)
    assert abs(sum(s * p for s, p in zip(sizes, parts)) - sum(s * p for s, p in zip(sizes, decided))) < 1e-5


def test_rounding_keeps_the_chances():
    sizes, parts = [5, 9, 2, 7], [0.3, 0.6, 0.25, 0.5]
    random = np.random.default_rng(3)
    mean = np.mean([mixing.decide(sizes, parts, random.random(4).tolist())[0] for _ in range(20_000)], axis=0)
    assert np.allclose(mean, parts, atol=0.015)


def test_mix_meets_the_targets(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.source_mix(spark, folder).collect()
    docs = {row.doc_id: row for row in documents(spark, folder).collect()}
    sizes, largest, taken, target = Counter(), Counter(), Counter(), {}
    for row in rows:
        doc = docs[row.doc_id]
        assert row["size"] == len(words_of(doc.text))
        sizes[doc.source] += row["size"]
        largest[doc.source] = max(largest[doc.source], row["size"])
        taken[doc.source] += row.taken
        target[doc.source] = row.target
        assert row.taken in {row["size"] * n for n in range(4)}
    wanted = plain_targets(sizes)
    for source in sizes:
        assert abs(target[source] - wanted[source]) < 1e-6 * wanted[source]
        assert abs(taken[source] - target[source]) <= largest[source]
    assert sorted(rows) == sorted(queries.source_mix(spark, folder).collect())


def test_tree_of_leaves_meets_the_targets(spark):
    docs = documents(spark, FOLDER).withColumn("source", F.when(F.col("doc_id") % 3 > 0, "hot").otherwise("b"))
    flat = mixing.copies(docs).collect()
    tree = mixing.copies(docs.repartition(7), leaf_rows=3, fan_in=4).collect()
    assert len(flat) == len(tree) == docs.count()
    for rows in (flat, tree):
        by_source = defaultdict(list)
        for row in rows:
            by_source[row.target].append(row)
        for target, members in by_source.items():
            assert abs(sum(r.copies * r["size"] for r in members) - target) <= max(r["size"] for r in members)
    assert sorted(tree) == sorted(mixing.copies(docs, leaf_rows=3, fan_in=4).collect())


def test_mixing_takes_any_rows(docs, empty):
    rows = mixing.copies(docs).collect()
    assert len(rows) == docs.count()
    assert all(0 <= row.copies <= 3 for row in rows)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(row.copies for row in rows)
    assert mixing.copies(empty).collect() == [] and mixing.mixed(empty).collect() == []


# URLs


URLS = [
    None,
    "",
    "no scheme",
    "http://",
    "http://COM/",
    "HTTP://Www.Example.COM/en/x?y#z",
    "https://a.www.example.com/en/",
    "https://b.example.com/en/login",
    "https://b.example.com/EN/",
    "http://example.com",
    "http://com.evil.org/ads/x",
    "http://x.net/es/1://y.com/",
    "http://x.net/fr?p=/",
    "http://x.net/fr/",
    "http://x.net/it/",
    "http://ads.x.org/",
    "http://loads.x.org/",
    "http://x.org/banner",
    "http://x.org/banners",
    "http://x.org/?a&sessionid=4",
    "http://x.org/xmlrpcAphp",
    "http://x.org/xmlrpc.php",
    "http://x.org:80/a/print.html?q",
    "http://x.example:80/é?ref=1",
]


def plain_verdict(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    whole = re.match(r"[^/?#]*", rest)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), whole)
    path = re.match(r"[^?#]*", rest[len(whole) :])[0]
    fits = [
        (len(name + start), name + start, verdict)
        for name, start, verdict in url_rules.HOST_RULES
        if (host == name or host.endswith("." + name)) and path.startswith(start)
    ]
    low = re.sub("[A-Z]", lambda m: m[0].lower(), url or "")
    hits = [p for p in url_rules.PATTERNS if url is not None and re.search(url_rules.Pattern.of(p).regex, low)]
    pattern = min(hits, default=None)
    if fits:
        return host, path, max(fits)[1], max(fits)[2], pattern
    return host, path, None, "block" if pattern else "allow", pattern


def test_urls_equal_every_rule_on_every_url(spark):
    rows = [(n, url) for n, url in enumerate(URLS)] + [(5, URLS[5]), (None, URLS[15])]
    frame = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(1)).withColumn("hit", F.lit(2))
    found = url_rules.judge(frame).select("page_id", "host", "path", "rule", "verdict", "pattern").collect()
    assert Counter(map(tuple, found)) == Counter((n, *plain_verdict(url)) for n, url in rows)
    assert any(row.pattern for row in found)
    assert url_rules.judge(frame.limit(0)).collect() == []


def test_rules_are_filed_under_their_rarest_token(spark):
    urls = spark.createDataFrame([("http://a.com/login/x",), ("http://a.com/login",), ("http://a.com/ads",)], "url string")
    index = {r.rule: r.token for r in url_rules.rule_index(urls, ("^login^ads^", "^a.com^login^", "*free", "free*.x^")).collect()}
    assert index == {"^login^ads^": "ads", "^a.com^login^": "login", "*free": "", "free*.x^": "x"}
    plan = url_rules.judge(spark.read.parquet(f"{FOLDER}/pages.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


# Exact duplicates


def plain_groups(rows):
    members = defaultdict(list)
    for row in rows:
        content = re.sub(r"[\x20\x09-\x0D]", "", row.text or "")
        members[content].append((-len(row.text or ""), row.doc_id is None, row.doc_id or 0, row.doc_id))
    return {content: (min(m)[3], len(m)) for content, m in members.items()}


def test_groups_equal_a_dictionary_of_texts(spark, docs, empty):
    extra = spark.createDataFrame(
        [(n, "hot text" + " " * (n % 7), "en", "s", 1) for n in range(1000, 1600)], SCHEMA
    )
    every = docs.select(*extra.columns).unionAll(extra)
    rows = every.collect()
    wanted = plain_groups(rows)
    found = content_sort.groups(every).collect()
    assert len(found) == len(rows)
    texts = {row.doc_id: re.sub(r"[\x20\x09-\x0D]", "", row.text or "") for row in rows}
    for row in found:
        if row.doc_id is not None:
            keep, size = wanted[texts[row.doc_id]]
            assert (row.keep_id, row.group_size) == (keep, size)
            assert not row.kept or row.doc_id == keep
    assert sum(row.kept for row in found) == len(wanted)
    kept = content_sort.one_of_each(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(plain_groups(docs.collect()))
    assert content_sort.groups(empty).collect() == [] and content_sort.one_of_each(empty).collect() == []


def test_content_sort_plan(spark):
    ranged = content_sort.runs(documents(spark, FOLDER), "doc_id", "text", 10_000, [])
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") >= 1 and "Python" not in plan
    hashed = re.findall(r"hashpartitioning\(([a-z]+)", plan)
    assert set(hashed) == {"tail"}  # counts of the sample; texts are moved by range only


@pytest.mark.parametrize("range_rows, least", [(20_000, 10), (40, 3)])
def test_equal_texts_are_found_beside_each_other(spark, monkeypatch, range_rows, least):
    monkeypatch.setattr(content_sort, "RANGE_ROWS", range_rows)
    monkeypatch.setattr(content_sort, "SAMPLE_LEAST", least)
    docs = documents(spark, "/root/testdata/sf0.01")
    hot = spark.createDataFrame([(n, "one hot text", "en", "s", 1) for n in range(10_000, 10_500)], SCHEMA)
    every = docs.unionByName(hot)
    rows = content_sort.runs(every, "doc_id", "text", every.count(), []).collect()
    copies = len(rows) - len({row.digest for row in rows})
    beside = sum(row.place > 1 for row in rows)
    hot_runs = {row.salt for row in rows if row.salt is not None}
    assert copies - beside <= max(0, len(hot_runs) - 1) and beside >= 0.97 * copies
    assert (len(hot_runs) > 5) == (range_rows == 40)
    found = {row.doc_id: row for row in content_sort.groups(every).collect()}
    wanted = plain_groups(every.collect())
    for row in every.collect():
        own = found[row.doc_id]
        assert (own.keep_id, own.group_size) == wanted[re.sub(r"[\x20\x09-\x0D]", "", row.text or "")]
    assert sum(row.kept for row in found.values()) == len(wanted)


# SimHash


def plain_fingerprint(text):
    words = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [words[i : i + 3] for i in range(max(1, len(words) - 2))] if words else []
    counts = [0] * 64
    for run in runs:
        h = xxhash.xxh64_intdigest(" ".join(run).encode(), seed=42)
        for bit in range(64):
            counts[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(runs))


def plain_components(prints):
    label = {p: p for p in prints}

    def root(p):
        while label[p] != p:
            p = label[p]
        return p

    prints = list(prints)
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 3:
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {p: root(p) for p in prints}


def check_simhash(docs):
    rows = docs.collect()
    prints = Counter(plain_fingerprint(row.text) for row in rows)
    root = plain_components(prints)
    smallest = {}
    for row in rows:
        group = root[plain_fingerprint(row.text)]
        if row.doc_id is not None:
            smallest[group] = min(smallest.get(group, row.doc_id), row.doc_id)
    wanted = Counter((r.doc_id, plain_fingerprint(r.text), smallest.get(root[plain_fingerprint(r.text)])) for r in rows)
    found = simhash.groups(docs).select("doc_id", simhash.as_hex("bits").alias("f"), "component_id").collect()
    assert Counter((r.doc_id, int(r.f, 16), r.component_id) for r in found) == wanted
    assert all(len(r.f) == 16 for r in found)
    return len(set(root.values()))


def test_simhash_equals_all_pairs(spark):
    check_simhash(documents(spark, FOLDER))


def test_simhash_takes_any_rows(docs, empty):
    groups = check_simhash(docs)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == groups
    assert simhash.groups(empty).collect() == [] and simhash.one_of_each(empty).collect() == []


def near_prints(random, count, centres, flips):
    middle = [random.getrandbits(64) for _ in range(centres)]
    prints = set()
    while len(prints) < count:
        p = random.choice(middle)
        for _ in range(random.randint(0, flips)):
            p ^= 1 << random.randrange(64)
        prints.add(p)
    return sorted(prints)


@given(st.integers(0, 10**6), st.integers(1, 200), st.integers(1, 40), st.integers(1, 9), st.integers(1, 4))
@hypothesis_settings(max_examples=40, deadline=None)
def test_bit_sliced_links_connect_what_all_pairs_connect(seed, count, centres, flips, keys):
    random = Random(seed)
    prints = near_prints(random, min(count, 20 * centres), centres, flips)
    random.shuffle(prints)
    key = sorted(random.randrange(keys) for _ in prints)
    ends = np.array([sum(k <= own for k in key) for own in key])
    label = simhash.linked(np.array(prints, np.uint64), ends)
    for own in set(key):
        members = [i for i, k in enumerate(key) if k == own]
        root = plain_components([prints[i] for i in members])
        together = defaultdict(set)
        for i in members:
            together[root[prints[i]]].add(i)
        for group in together.values():
            assert {int(label[i]) for i in group} == {min(group)}


@pytest.mark.parametrize("unlike_rows", [4096, 1e-9])
@pytest.mark.parametrize("key_rows", [1024, 16])
def test_links_over_tables_and_parts(spark, monkeypatch, unlike_rows, key_rows):
    """With 16 bits a key and with many blocks; with hot keys whole and dealt to parts."""
    monkeypatch.setattr(simhash, "KEY_ROWS", key_rows)
    if unlike_rows < 1:
        monkeypatch.setattr(simhash, "block_masks", lambda rows: BLOCKS_OF_SIX)
    prints = near_prints(Random(7), 400, 25, 5)
    frame = spark.createDataFrame([(simhash.signed(p),) for p in prints], "bits long")
    edges = simhash.links(frame, len(prints))
    found = {row.bits: row.root for row in simhash.components(edges).collect()}
    groups, wanted = defaultdict(set), defaultdict(set)
    for p, root in plain_components(prints).items():
        wanted[root].add(simhash.signed(p))
    for p in prints:
        groups[found.get(simhash.signed(p), simhash.signed(p))].add(simhash.signed(p))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))
    assert all(root == min(group) for root, group in groups.items())


BLOCKS_OF_SIX = simhash.block_masks(10**9)


def test_tables_grow_with_the_rows():
    assert len(simhash.block_masks(10**6)) == 4
    assert len(BLOCKS_OF_SIX) in (10, 20)
    for rows in (10, 10**9, 10**11):
        masks = simhash.block_masks(rows)
        for flips in ((0, 1, 2), (3, 30, 60), (15, 16, 47), (63, 31, 5)):
            changed = sum(1 << f for f in flips)
            assert any(mask & changed == 0 for mask in masks)


def test_a_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 400), (450, 500)], "a long, b long")
    found = {row.bits: row.root for row in simhash.components(edges).collect()}
    assert found == {**{i: 0 for i in range(201)}, 400: 400, 450: 400, 500: 400}


# Pipeline


def test_pipeline_stages(spark, docs):
    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = new_path(spark, "test")
        stage(spark, rows, FOLDER).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == docs.columns, name
        assert {r.doc_id for r in after.collect()} <= {r.doc_id for r in rows.collect()}
        rows = after
    assert corpus_pipeline.STAGES[-1][1](spark, rows, FOLDER).count() == rows.count()


def test_pipeline_equals_its_steps_by_hand(spark, tmp_path):
    rows = [(n, f"{n % 5} " + " ".join(f"w{(n * 7 + i) % 97}x{n // 4}" for i in range(60)), "en", f"s{n % 2}", 0) for n in range(40)]
    rows += [(100 + n, rows[n][1] + " ", "en", "s0", 0) for n in range(10)]  # longer copies: these stay
    rows += [(200 + n, "same line here again\n" * 10, "en", "s1", 0) for n in range(5)]  # repetitive: these go
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    result = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = Counter(row.doc_id for row in result)
    assert not any(200 <= n for n in ids)
    assert not any(n < 10 for n in ids)
    text = {n: t for n, t, *_ in rows}
    unique = [n for n in text if 10 <= n < 200]
    groups = plain_components({plain_fingerprint(text[n]) for n in unique})
    stay = {}
    for n in sorted(unique):
        stay.setdefault(groups[plain_fingerprint(text[n])], n)
    assert set(ids) <= set(stay.values())
    source = {n: s for n, _, _, s, _ in rows}
    sizes = Counter()
    for n in stay.values():
        sizes[source[n]] += len(words_of(text[n]))
    taken = Counter()
    for n, times in ids.items():
        taken[source[n]] += times * len(words_of(text[n]))
    targets = plain_targets(sizes)
    assert all(abs(taken[s] - targets[s]) <= 61 for s in sizes)
    tokens = {r.doc_id: r.n_tokens for r in pieces.encode(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(row.n_tokens == tokens[row.doc_id] for row in result)
