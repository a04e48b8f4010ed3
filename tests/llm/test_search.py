"""Exact searches and the conversation trie against brute force and SQL."""

import hashlib
import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from math import floor, log

import numpy as np
import pyarrow as pa
import pytest
from compare import assert_same, connect
from pyspark.sql import functions as F

from tableloom.llm import norm_buckets, queries, turn_trie
from tableloom.llm.impact_index import ImpactIndex, top_products
from tableloom.llm.norm_buckets import Item, rank_documents, terms_of
from tableloom.llm.turn_trie import conversation_trie


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_their_sql(spark, folder, name):
    assert assert_same(queries.QUERIES[name](spark, folder), connect(folder), queries.ORACLES[name])


@pytest.mark.parametrize("spread", [1, 40, 300])
def test_index_keeps_all_members(spread):
    rng = np.random.default_rng(spread)
    rows = rng.integers(-spread, spread + 1, (700, 12))
    rows[::9] = rows[4]
    index = ImpactIndex(rows)
    for query in [*rows[:20], np.zeros(12, int), rng.integers(-spread, 1, 12)]:
        for own in (-1, 4):
            found, scores = index.top(query, 5, own)
            assert (scores == rows[found] @ query).all() and own not in found
            all_scores = np.delete(rows @ query, own) if own >= 0 else rows @ query
            bar = np.sort(all_scores)[-5]
            reach = set(np.flatnonzero(rows @ query >= bar).tolist()) - {own}
            assert reach <= set(found.tolist())


@pytest.mark.parametrize("n, width, k", [(1, 1, 1), (1, 5, 3), (4, 3, 9), (300, 1, 5), (300, 40, 1), (900, 7, 5)])
def test_index_of_any_shape(n, width, k):
    rng = np.random.default_rng(n + width)
    rows = rng.integers(-60, 61, (n, width))
    rows[:, ::3] = 7
    queries = rng.integers(-60, 61, (40, width)) * rng.integers(0, 2, (40, width))
    index = ImpactIndex(rows)
    for query in [*queries, *rows[:5]]:
        for own in (-1, n - 1):
            found, scores = index.top(query, k, own)
            every = rows @ query
            others = np.delete(np.arange(n), own) if own >= 0 else np.arange(n)
            assert scores.dtype == np.int64 and (scores == every[found]).all()
            assert len(set(found.tolist())) == len(found) and own not in found
            bar = np.sort(every[others])[-min(k, len(others))] if len(others) else 0
            assert set(others[every[others] >= bar].tolist()) <= set(found.tolist())


def test_steps_of_a_walk_do_not_grow_with_the_dimensions():
    rng = np.random.default_rng(7)
    rows = np.floor(rng.normal(0, 30, (4096, 64))).astype(int)
    index, calls = ImpactIndex(rows), []
    for query in rows[:10]:
        sys.setprofile(lambda _, event, __: calls.append(event) if event.endswith("call") else None)
        try:
            index.top(query, 5, 0)
        finally:
            sys.setprofile(None)
    assert len(calls) < 10 * 600


def test_index_ends_before_all_rows():
    rng = np.random.default_rng(1)
    rows = np.round(rng.exponential(4, (4000, 8)) ** 2).astype(int)
    found, _ = ImpactIndex(rows).top(rows[np.argmax(rows.sum(axis=1))], 5)
    assert len(found) < 400


VECTORS = "vec_id long, embedding array<double>, label int, cell long, query long"


def brute_products(rows, k, every):
    kept = [
        (i, key, [floor(256 * x) for x in vector])
        for i, (key, vector, *_) in enumerate(rows)
        if vector is not None and all(x is not None and abs(x) < float("inf") for x in vector)
    ]
    made = []
    for i, key, query in kept:
        if key is None or key % every:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(query, vector, strict=False)), other is None, other or 0)
            for j, other, vector in kept
            if j != i
        )
        made += [
            (key, rank, None if null else other, -minus)
            for rank, (minus, null, other) in enumerate(scored[:k], 1)
        ]
    return sorted(made, key=repr)


def test_top_products_of_odd_rows(spark):
    rng = random.Random(3)
    rows = [(i, [round(rng.uniform(-1, 1), 2) for _ in range(5)]) for i in range(60)]
    rows += [(10, [0.5] * 5), (10, [0.5] * 5), (61, [0.5] * 5), (None, [0.9] * 5), (70, None)]
    rows += [(80, [0.1, None]), (90, [float("nan")]), (95, [float("inf")]), (20, []), (30, [3.0])]
    rows = [(*row, 1, 2, 3) for row in rows]
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    for block, part in ((4096, 4096), (7, 2)):
        made = top_products(df, "vec_id", "embedding", F.col("vec") % 10 == 0, 4, block, part)
        assert sorted(map(tuple, made.collect()), key=repr) == brute_products(rows, 4, 10)


def test_top_products_beyond_doubles_and_without_rows(spark):
    rows = [(i, [10.0 ** (2 * i), -7.0 - i]) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    made = top_products(df, "vec_id", "embedding", F.col("vec") % 2 == 0, 2)
    assert sorted(map(tuple, made.collect()), key=repr) == brute_products(rows, 2, 2)
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert top_products(none, "vec_id", "embedding", F.col("vec") % 2 == 0, 2).count() == 0


PATTERN = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def plain_terms(text):
    return PATTERN.findall((text or "").translate(LOWER))


def test_terms_equal_the_pattern():
    texts = ["", None, "ÀB-c9_d", " \x1c x Y\x0b", "漢字 ß\U0001f600!A" * 3, "0", "É" * 5000]
    made = terms_of(pa.array(["skipped", *texts]).slice(1))
    listed = made.listed.to_pylist()
    for text, begin, end in zip(texts, made.bounds, made.bounds[1:], strict=False):
        assert [listed[c] for c in made.codes[begin:end]] == plain_terms(text)


def brute_ranks(docs, items, k):
    counts = [(key, Counter(plain_terms(text))) for key, text in docs]
    counts = [(key, tf) for key, tf in counts if tf]
    total = sum(sum(tf.values()) for _, tf in counts)
    holders = Counter(term for _, tf in counts for term in tf)
    weight = {
        t: floor(1000 * log((2 * len(counts) + 2) / (2 * df + 1))) for t, df in holders.items()
    }
    made = []
    for item, text in items:
        asked, scored = Counter(plain_terms(text)), []
        for key, tf in counts:
            m = 25 + (75 * sum(tf.values()) * len(counts)) // total
            score = sum(
                often * weight[t] * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
                for t, often in asked.items()
                if t in tf
            )
            if score > 0:
                scored.append((-score, key is None, key or 0))
        made += [
            (item, rank, None if null else key, -minus)
            for rank, (minus, null, key) in enumerate(sorted(scored)[:k], 1)
        ]
    return sorted(made, key=repr)


def test_ranks_of_odd_rows(spark, odd_documents, no_documents, monkeypatch):
    monkeypatch.setattr(norm_buckets, "BLOCK_ITEMS", 3)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(40)] + ["É", "the", "漢字"]
    odd = [(r.doc_id, r.text) for r in odd_documents.collect()]
    more = [(100 + i, " ".join(rng.choices(words, k=rng.randint(1, 60)))) for i in range(200)]
    more += [(400 + i, "the the w1 w2 w3") for i in range(30)]
    items = [(i, " ".join(rng.choices(words, k=9))) for i in range(6)]
    items += [(7, ""), (8, None), (9, "unknownterm"), (9, "river MILL the"), (None, "w1 w1 w2")]
    docs = spark.createDataFrame(odd + more, "doc_id long, text string").withColumn("n", F.lit("x"))
    asked = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, score string")
    made = rank_documents(docs, asked, 5)
    assert sorted(map(tuple, made.collect()), key=repr) == brute_ranks(odd + more, items, 5)
    assert rank_documents(no_documents, asked, 5).count() == 0
    assert rank_documents(docs, asked.limit(0), 5).count() == 0


def test_buckets_leave_documents_out():
    """Few documents are scored exactly once a good threshold is known."""
    rng = np.random.default_rng(2)
    n, size = 1000, 400
    lists = [np.sort(rng.choice(size, 30, replace=False)) for _ in range(n)]
    counts = rng.integers(1, 4, 30 * n)
    rows = pa.RecordBatch.from_arrays(
        [
            pa.array(np.arange(n)),
            pa.array(np.full(n, 30)),
            pa.ListArray.from_arrays(np.arange(0, 30 * n + 1, 30), pa.array(np.concatenate(lists))),
            pa.ListArray.from_arrays(np.arange(0, 30 * n + 1, 30), pa.array(counts)),
            pa.array(np.zeros(n)),
        ],
        ["doc_id", "n", "terms", "counts", "norm"],
    )
    bucket = norm_buckets.Bucket(rows, size, n, 30 * n)
    bucket.norms = np.sqrt(np.add.reduceat(bucket.impacts.astype(float) ** 2, np.arange(0, 30 * n, 30)))
    item = Item.of(lists[5], rng.integers(1000, 9000, 30))
    scores = bucket.scores(item, np.arange(n), np.zeros(size, np.int64))
    bar = np.sort(scores)[-10]
    found = bucket.reaching(item, float(bar))
    assert set(np.flatnonzero(scores >= bar).tolist()) <= set(found.tolist())
    assert len(found) < 40


def brute_trie(rows):
    given = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            given[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v, key=lambda t: t[:2])] for c, v in given.items()}
    members, ended, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for conv, own in turns.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - abs(conv) % 20 * (1 if conv >= 0 else -1)
        path = tuple(turns.get(base, [])[:h] + own[h:])
        ended[path].append(conv)
        for depth in range(len(path) + 1):
            members[path[:depth]].append(conv)
            if depth:
                children[path[: depth - 1]].add(path[:depth])
    leaves, saved = Counter(), Counter()
    for path, convs in members.items():
        words = len(re.findall("[^\x20\x09-\x0d]+", path[-1][1])) if path else 0
        for depth in range(len(path) + 1):
            leaves[path[:depth]] += path not in children
            saved[path[:depth]] += (len(convs) - 1) * words
    return sorted(
        (
            min(convs),
            len(path),
            min(members[path[:-1]]) if path else None,
            len(convs),
            len(children[path]),
            leaves[path],
            saved[path],
            hashlib.sha256(",".join(map(str, sorted(ended[path]))).encode()).hexdigest(),
        )
        for path, convs in members.items()
    )


TURNS = "conv_id long, turn long, role string, text string, shard int, key string"
NODE = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def trie_rows(spark, rows):
    df = spark.createDataFrame([(*row, 1, "x") for row in rows], TURNS).repartition(4)
    return sorted(map(tuple, conversation_trie(df).select(*NODE).collect()))


def shared_turns(seed, convs, longest):
    rng = random.Random(seed)
    rows = []
    for conv in convs:
        steps = rng.choice([1, 3, longest]) if rng.random() < 0.5 else longest
        same = rng.random() < 0.6
        for turn in range(rng.randint(1, steps)):
            text = "same words here" if same else rng.choice(["a", "b  b", "", None, " c\n"])
            rows.append((conv, turn if turn else None, ["user", "assistant"][turn % 2], text))
    return rows


@pytest.mark.parametrize("shard_rows, blocks", [(32_768, 256), (3, 2)])
def test_trie_equals_brute_force(spark, monkeypatch, shard_rows, blocks):
    monkeypatch.setattr(turn_trie, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(turn_trie, "BLOCK_BANDS", blocks)
    convs = [*range(0, 70), *range(-25, -1), 10**12 + 3]
    rows = shared_turns(5, convs, 90) + [(None, 1, "user", "x"), (200, None, None, None)]
    assert trie_rows(spark, rows) == brute_trie(rows)


def test_trie_of_copies_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(turn_trie, "SHARD_ROWS", 20)
    rows = [(conv, turn, "user", "one two") for conv in range(0, 4000, 20) for turn in range(20)]
    rows += [(7, 1, "user", "one two")] * 40
    assert trie_rows(spark, rows) == brute_trie(rows)


def test_trie_without_conversations(spark):
    assert trie_rows(spark, []) == []
    assert trie_rows(spark, [(None, 1, "user", "x")]) == []
