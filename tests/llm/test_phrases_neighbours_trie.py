"""Collocations, approximate neighbours and the prefix trie against brute force and SQL, on nulls, empty
and long texts, ties, repeated rows, empty tables and extra columns with clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from pairforge.llm import collocations, posting_lists, prefix_trie
from tests.conftest import SF_SMALL


# Collocations

DOCS = "doc_id bigint, text string, lang string, f bigint, phrase string, k int"


def brute_collocations(rows):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= 30}
        best = []
        for p, a in cand.items():
            score, k = min((2_000_000 * a // (c[p[:j]] + c[p[j:]]), j) for j in range(1, len(p)))
            longer = [b for q, b in cand.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not any(100 * b >= 80 * a for b in longer):
                best.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(best)[:2000], 1)]
    return sorted(out)


def phrase_rows():
    rng = random.Random(2)
    words = ["New", "york", "é", "ab", "of", "the", " x", "city", "z" * 50]
    rows = [(rng.choice(["en", "fr", None, "und"]), " ".join(rng.choice(words) + rng.choice(["", "", "", ",", ".", "\t", "\n", "  "]) for _ in range(rng.randint(0, 60)))) for _ in range(150)]
    rows += [("en", "machine learning is fun. " * 40), ("en", "Machine Learning")] * 3 + [("en", None), (None, None), ("fr", ""), ("fr", " \t ,. ")]
    return [*rows, ("de", " ".join(rng.choice("abc") for _ in range(5000))), ("de", "q" * 20_000)]


@pytest.mark.parametrize("bounds", [{}, {"max_words": 0, "most_bits": 6}, {"window": 300, "filter_entries": 50, "merge_entries": 20}])
def test_collocations_match_brute_force(spark, bounds):
    rows = phrase_rows()
    df = spark.createDataFrame([(i, t, lang, 1, "x", 1) for i, (lang, t) in enumerate(rows)], DOCS)
    got = collocations.collocations(df.repartition(5), **bounds)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute_collocations(rows)
    assert len(want) > 50 and sorted(map(tuple, got.collect())) == want


def test_collocations_scores_beyond_64_bits_and_top(spark):
    counts = spark.createDataFrame([("en", "a", 1, 9 * 10**18), ("en", "b", 1, 9 * 10**18), ("en", "a b", 2, 9 * 10**18 - 1)], "lang string, phrase string, k int, f bigint")
    totals = spark.createDataFrame([("en", 5)], "lang string, n bigint")
    real = collocations.frequent_phrases
    collocations.frequent_phrases = lambda docs, **bounds: (totals, counts)
    try:
        assert [tuple(r) for r in collocations.collocations(None).collect()] == [("en", 1, "a b", 9 * 10**18 - 1, 9 * 10**18, 9 * 10**18, 5, 999_999)]
        assert collocations.collocations(None, top=0).count() == 0
    finally:
        collocations.frequent_phrases = real


@pytest.mark.parametrize("bits,n,bucket_bits", [(3, 4, 4), (17, 3, 4), (21, 4, 0), (30, 4, 9), (64, 3, 4)])
def test_quotient_filters_are_lossless(bits, n, bucket_bits):
    rng = np.random.default_rng(bits)
    ids = [rng.integers(0, 1 << min(bits, 63), 3000, dtype=np.uint64) for _ in range(n)]
    for i in range(n):
        ids[i][2000:] = ids[i][1000:2000]
    lanes = collocations.pack(ids, bits)
    assert all((a == b).all() for a, b in zip(ids, collocations.unpack(collocations.unpermute(collocations.permute(lanes)), bits, n), strict=True))
    assert (collocations.unspread(collocations.spread(lanes[0])) == lanes[0]).all()
    counts = rng.integers(1, 600, 3000)
    merged, total = collocations.combine([(collocations.permute(lanes), counts)])
    want = Counter()
    for row, c in zip(zip(*(x.tolist() for x in ids), strict=True), counts.tolist(), strict=True):
        want[row] += c
    back = Counter()
    for bucket in range(1 << bucket_bits):
        at = np.flatnonzero(merged[0] >> np.uint64(64 - bucket_bits) == bucket) if bucket_bits else np.arange(len(total))
        if len(at):
            block = collocations.QuotientFilter.dump([x[at] for x in merged], total[at], bucket_bits)
            some, c = collocations.QuotientFilter.load(block, bucket)
            for row, x in zip(zip(*(y.tolist() for y in collocations.unpack(collocations.unpermute(some), bits, n)), strict=True), c.tolist(), strict=True):
                back[row] += x
    assert back == want


def test_equal_first_lanes_stay_apart():
    a, b = np.array([5, 5, 5, 5], np.uint64), np.array([1, 2, 1, 2], np.uint64)
    lanes, counts = collocations.combine([([a, b], np.ones(4, np.int64))])
    assert lanes[1].tolist() == [1, 2] and counts.tolist() == [2, 2]


def test_collocations_empty(spark):
    assert collocations.collocations(spark.createDataFrame([], DOCS)).count() == 0


# Approximate neighbours

VECTORS = "vec_id bigint, embedding array<float>, lists string, score double, query_id bigint, rank int"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", 1.0, 2, 3) for i, v in rows], VECTORS)


def brute_neighbours(rows, k=10, every=100):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)]
    width = max((len(v) for _, v in ok), default=0)
    ok = [(i, np.pad(v, (0, width - len(v)))) for i, v in ok]
    out = []
    for q, x in {(i, tuple(v)) for i, v in ok if i % every == 0}:
        d = sorted((float(np.sqrt(((v - np.array(x)) ** 2).sum())), i) for i, v in ok if i != q)
        out += [(q, rank, i, s) for rank, (s, i) in enumerate(d[:k], 1)]
    return sorted(out)


def test_neighbours_exact_on_few_lists(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(40)] + [(i, [1, 0, 0]) for i in range(40, 60)] + [(60, [1, 0, 0])] * 3
    rows += [(100, [1.0, 0, 0]), (200, [0.5] * 6), (200, [0.5] * 6), (61, None), (62, [None, 1]), (63, [float("nan")]), (64, [float("inf")]), (65, [0, 0]), (66, []), (None, [1, 2]), (300, [0.0])]
    got = posting_lists.search_table(vectors_of(spark, rows))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    have, want = sorted(map(tuple, got.collect())), brute_neighbours(rows)
    assert [r[:3] for r in have] == [r[:3] for r in want] and np.allclose([r[3] for r in have], [r[3] for r in want], rtol=1e-12)


def test_neighbours_recall_parts_and_far_copies(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 16)) * 4
    rows = [(i, (centres[rng.integers(30)] + rng.normal(size=16)).tolist()) for i in range(3000)]
    rows += [(3000 + i, rows[7][1]) for i in range(1500)]  # a hot point: a third of all rows
    df = vectors_of(spark, rows).repartition(7)
    usable = df.filter(posting_lists.taking_part(df["embedding"]))
    lists = posting_lists.fit(usable, list_rows=50)
    assert len(lists.centroids) > 40 and lists.ratio < 3
    x = np.array([v for _, v in rows])
    assert lists.select(x[::100]).mean() < 0.5  # the ratio leaves lists out
    assert (lists.assign(x)[:, 1] >= 0).any() and (lists.assign(x)[:, 1] < 0).any()
    got = posting_lists.search(usable, usable.filter("vec_id % 100 = 0"), lists, part_rows=40, query_rows=5).collect()
    want, found = brute_neighbours(rows), defaultdict(list)
    for r in got:
        found[r.query_id].append(r.vec_id)
    truth = defaultdict(set)
    for q, _, i, _ in want:
        truth[q].add(i)
    assert all(len(v) == len(set(v)) == 10 for v in found.values()) and set(found) == set(truth)
    assert np.mean([len(truth[q] & set(found[q])) / 10 for q in truth]) >= 0.9


def test_neighbours_lists_full_of_the_querys_own_id(spark):
    rng = np.random.default_rng(5)
    rows = [(100, (rng.normal(size=8) * 0.01 + 5).tolist()) for _ in range(200)] + [(i, rng.normal(size=8).tolist()) for i in range(101, 180)]
    df = vectors_of(spark, rows)
    got = posting_lists.search_table(df, list_rows=8).groupBy("query_id").count().collect()
    asked = df.filter("vec_id = 100").select("embedding").distinct().count()
    assert [(r[0], r[1]) for r in got] == [(100, 10 * asked)]


def test_graph_search_finds_the_nearest_centroids():
    rng = np.random.default_rng(6)
    c = rng.normal(size=(500, 12))
    edges, entry = posting_lists.linked(c)
    x = rng.normal(size=(200, 12))
    ids, d = posting_lists.Lists(c, edges, entry, 1.0).nearest(x, 32)
    true = posting_lists.squares(x, c).argsort(1)[:, :5]
    assert np.mean([len(set(a[:5]) & set(b)) / 5 for a, b in zip(ids.tolist(), true.tolist(), strict=True)]) > 0.95 and (np.diff(d, axis=1) >= 0).all()
    sizes = [len(g) for g in posting_lists.halved(x, 7)]
    assert sum(sizes) == 200 and max(sizes) - min(sizes) <= 2


def test_neighbours_empty(spark):
    assert posting_lists.search_table(vectors_of(spark, [])).count() == 0
    assert posting_lists.search_table(vectors_of(spark, [(0, [0.0]), (100, None)])).count() == 0
    assert posting_lists.search_table(vectors_of(spark, [(0, [1.0])])).count() == 0


# Prefix trie

CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string, key string, depth int, parent string, words int"


def brute_trie(rows):
    digest = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest()
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((-math.inf if turn is None else turn, role or "", digest(role or "", text or ""), text or ""))
    turns = {c: [(r, t) for _, r, _, t in sorted(v)] for c, v in convs.items()}
    paths = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = tuple(turns.get(c - c % 20, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    out = []
    for node, m in members.items():
        below = [x for x in members if x[: len(node)] == node]
        children = [x for x in below if len(x) == len(node) + 1]
        words = lambda x: len(re.findall("[^\x20\x09-\x0d]+", x[-1][1])) if x else 0
        out.append((
            min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children),
            sum(not any(y[:-1] == x and len(y) == len(x) + 1 for y in below) for x in below), sum((len(members[x]) - 1) * words(x) for x in below),
            hashlib.sha256(",".join(map(str, sorted(c for c in m if len(paths[c]) == len(node)))).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def talk_rows():
    rng = random.Random(8)
    rows = []
    for c in range(130):
        if c % 20 == 0 and c in (40, 60):
            continue  # no base
        for turn in range(rng.randint(1, 4)):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["a", "a b", "", None, "a b c\td"])))
    rows += [(200 + c, t, "user", f"step {t}") for c in range(30) for t in range(9)]  # a group of copies
    rows += [(7, None, "system", "first"), (7, 0, "user", "a"), (7, 0, "user", "a"), (8, 0, "z", "tie"), (8, 0, "b", "tie"), (None, 0, "user", "x"), (400, 0, "u", "long " * 3000)]
    return rows + [(500, t, "user", str(t % 3)) for t in range(300)] + [(501, t, "user", str(t % 3)) for t in range(290)]


@pytest.mark.parametrize("bounds", [{}, {"shard_nodes": 5, "block": 4, "queue": 2}])
def test_trie_matches_brute_force(spark, bounds):
    rows = talk_rows()
    df = spark.createDataFrame([(*r, "k", 1, "p", 2) for r in rows], CONVERSATIONS).repartition(5)
    got = prefix_trie.build(df, **bounds)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_trie(rows)


def test_trie_only_turnless_and_empty(spark):
    assert prefix_trie.build(spark.createDataFrame([], CONVERSATIONS)).count() == 0
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 > 0)
    rows = [(c, 0, "user", "one two")]  # its only turn is dropped and its base is absent
    df = spark.createDataFrame([(*r, "k", 1, "p", 2) for r in rows], CONVERSATIONS)
    assert [tuple(r) for r in prefix_trie.build(df).collect()] == brute_trie(rows)


def test_spilling_queue_keeps_order():
    rng = random.Random(1)
    queue, items = prefix_trie.SpillingQueue(8), [(rng.randint(-9, 0), bytes([rng.randint(0, 255)]), i, 0) for i in range(500)]
    out = []
    for i, x in enumerate(items):
        queue.push(x)
        if i % 3 == 0:
            out.append(queue.peek())
            assert queue.pop() == out[-1]
    assert queue.runs > 3
    while queue.peek() is not None:
        out.append(queue.pop())
    assert sorted(out) == sorted(items) and out[167:] == sorted(out[167:])


@pytest.mark.parametrize("name,table", [("op11_collocations", "documents"), ("op13_trie", "conversations")])
def test_queries_match_sql(spark, name, table):
    from pairforge.llm import queries

    got = queries.QUERIES[name](spark, SF_SMALL)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_SMALL}/{table}.parquet')")
    want = con.execute(queries.ORACLE_SQL[name])
    assert [d[0] for d in want.description] == got.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.fetchall(), key=str)
