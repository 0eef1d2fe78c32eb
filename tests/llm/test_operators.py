"""Each training-data operator against brute force on small tables with nulls, empty and long texts,
ties, repeated rows, empty tables and extra columns with clashing names."""

import hashlib
import math
import random

import numpy as np
import pytest

from pairforge.llm import bpe, fingerprint, html_text, jaccard, lines, mixing, quality, substrings, topk, toxicity

DOCS = "doc_id bigint, text string, source string, lang string, n_chars bigint, score double, n_words int, copy_no int, n_lines int, severity int"


def docs_of(spark, rows):
    """rows: (doc_id, text, source); the other columns only clash with results."""
    return spark.createDataFrame([(d, t, s, "en", None, 0.5, 1, 1, 1, 1) for d, t, s in rows], DOCS)


def odd_texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    long = " ".join(rng.choice(words) for _ in range(6000))
    base = " ".join(rng.choice(words) for _ in range(120))
    return [
        (0, None, "a"), (1, "", "a"), (2, "  \t\n ", None), (3, "one", "b"), (4, "one", "b"), (5, base, "a"), (6, base, "a"), (7, base + " tail", "b"),
        (8, "head " + base, None), (9, long, "a"), (9, long, "a"), (10, long + " x", "c"), (11, "É x " * 60, "c"), (12, "a b c d e", "c"), (13, "A B C D E", "c"), (None, base, "a"),
    ]


def brute_windows(rows, width):
    key = lambda d: math.inf if d is None else d
    first, split = {}, [(d, (t or "").encode().split()) for d, t, _ in rows]
    for d, w in split:
        for i in range(len(w) - width + 1):
            k = tuple(w[i : i + width])
            first[k] = min(first.get(k, math.inf), key(d))
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - width + 1):
            if first[tuple(w[i : i + width])] < key(d):
                gone.update(range(i, i + width))
        out.append((d, len(w), len(gone), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("shard_contexts", [256, 1])
def test_substrings_match_brute_force(spark, shard_contexts):
    rows = odd_texts()
    got = substrings.remove_repeats(docs_of(spark, rows), digest=True, shard_contexts=shard_contexts)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_windows(rows, 50)


def test_substrings_text_and_short_windows(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 40))), None) for i in range(60)]
    got = substrings.remove_repeats(docs_of(spark, rows), width=9)
    assert sorted(((r[0], r[1], r[2], hashlib.sha256(r[3].encode()).hexdigest()) for r in got.collect()), key=str) == brute_windows(rows, 9)


def test_automaton_statistics():
    a = substrings.Automaton()
    a.add(list("abcbc"), 3)
    a.add(list("xbcbcb"), 7)
    assert a.covered(list("abcbcb"), 8, 3) == [0, 1, 2, 3]
    assert a.covered(list("bcbcb"), 7, 4) == [0]  # "cbcb" only occurs with owner 7
    assert a.covered(list("zzz"), 9, 2) == []


def brute_components(rows):
    ids = [d for d, _, _ in rows if d is not None]
    sets = []
    for d, t, _ in rows:
        w = (t or "").encode().lower().split()
        s = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets.append((d, s))
    up = {d: d for d in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return sorted(((d, len(s), None if d is None else root(d)) for d, s in sets), key=str)


def test_jaccard_odd_rows(spark):
    rows = odd_texts()
    got = jaccard.near_duplicates(docs_of(spark, rows))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_components(rows)


def test_forest_connects_what_links_do():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 40).astype(np.uint64)
    sets = [np.unique(np.where(rng.random(40) < 0.1, rng.integers(0, 2**63, 40).astype(np.uint64), base)) for _ in range(300)]
    comps, blocks = [i // 3 for i in range(300)], [i % 2 for i in range(300)]

    def groups(pairs):
        up = list(range(100))
        for a, b in pairs:
            x, y = up[comps[a]], up[comps[b]]
            up = [x if u == y else u for u in up]
        return [up.index(u) for u in up]

    for block in ([0] * 300, blocks):
        got = jaccard.forest(sets, comps, block)
        every = [(a, b) for a in range(300) for b in range(a) if (len(set(block)) == 1 or block[a] != block[b]) and jaccard.linked(sets[a], sets[b])]
        assert all(jaccard.linked(sets[a], sets[b]) for a, b in got) and len(got) < 100
        assert groups(got) == groups(every)


@pytest.mark.parametrize(("frequent", "tile"), [((2, 8), 200_000), ((2, 4), 300)])
def test_jaccard_families_match_brute_force(spark, monkeypatch, frequent, tile):
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "LOCAL", frequent[0])
    monkeypatch.setattr(jaccard, "TOTAL", frequent[1])
    monkeypatch.setattr(jaccard, "SENT", 2)
    rng = random.Random(3)
    words = [str(i) for i in range(2000)]
    common, rows = [rng.choice(words) for _ in range(30)], []
    for f in range(40):
        base = [rng.choice(words) for _ in range(rng.choice([3, 5, 6, 8, 12, 20, 40, 70, 120]))]
        if f % 3 == 0:
            base = base[: len(base) // 3] + common + base[len(base) // 3 :]
        for _ in range(rng.randint(1, 10)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 18))):
                w[rng.randrange(len(w))] = rng.choice(words)
            rows.append(" ".join(w))
    rng.shuffle(rows)
    rows = [(i, t, None) for i, t in enumerate(rows)]
    got = jaccard.near_duplicates(docs_of(spark, rows).repartition(3))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_components(rows)


def test_signatures_of_linked_sets_meet():
    rng = np.random.default_rng(0)
    for _ in range(400):
        n = int(rng.integers(1, 90))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        drop = int(rng.integers(0, max(1, len(a) // 5) + 1))
        b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**63, int(rng.integers(0, max(1, n // 6) + 1))).astype(np.uint64)]))
        rank = lambda x: np.where(x % np.uint64(3) == 0, 1 + (x % np.uint64(2)).astype(np.int64), 0)
        if jaccard.linked(a, b):
            assert jaccard.may_link(len(a), jaccard.sketch(a), len(b), jaccard.sketch(b))
            (sa, ka), (sb, kb) = jaccard.signatures(a, rank(a)), jaccard.signatures(b, rank(b))
            both, i, j = np.intersect1d(sa, sb, return_indices=True)
            fine = lambda k: (k >> 33) & (2**31 - 1)
            few = 7 * (fine(ka[i]) + fine(kb[j])) <= len(a) + len(b)
            usable = (ka[i] & 3 == 0) | (((ka[i] & 3 == 2) | (kb[j] & 3 == 2)) & few)
            assert usable.any()


@pytest.mark.parametrize("leaf", [2, 5, 512])
def test_tree_concatenation_equals_the_library(leaf):
    b = bpe.Bpe(bpe.default_vocabulary(), leaf)
    rng = random.Random(leaf)
    alphabet = "abcdethenings éñ1234'<|>$%!́ 中"
    cases = ["", "<|endoftext|>x<|startoftext|>", "it's we'll I'D", "a" * 400, "thethethe" * 60, "1" * 300]
    cases += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 900))) for _ in range(60)]
    cases += ["".join(rng.choice("theinga") for _ in range(700)) for _ in range(10)]
    for t in cases:
        want = b.whole.encode(t, add_special_tokens=False).ids
        assert b.encode_ids(t) == want
        assert [i for w in t.encode().split() for i in b.long_run(w.decode())] == want


def test_bpe_documents(spark):
    rows = odd_texts() + [(20, "thething" * 3000, "a"), (21, "x " * 500 + "abc" * 4000 + "<|endoftext|> y" * 90, "a"), (21, "x " * 500 + "abc" * 4000 + "<|endoftext|> y" * 90, "a")]
    whole = bpe.Bpe(bpe.default_vocabulary()).whole
    want = []
    for d, t, _ in rows:
        ids = whole.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(whole.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    for chars in (65_536, 700):
        got = bpe.digest_documents(docs_of(spark, rows), split_chars=chars, leaf=64)
        assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)
    text = {r.doc_id: r.decoded for r in bpe.encode_documents(docs_of(spark, rows)).collect()}
    assert text[3] == "one</w>" and text[0] == ""


def test_fingerprints(spark):
    rows = odd_texts()
    got = fingerprint.compare_with_next(docs_of(spark, rows).repartition(3)).collect()
    order = sorted(rows, key=lambda r: -1 if r[0] is None else r[0], reverse=True)
    follows = {d: order[(i + 1) % len(order)][1] or "" for i, (d, _, _) in enumerate(order)}
    text = {d: t or "" for d, t, _ in rows}
    assert len(got) == len(rows)
    for r in got:
        t = text[r.doc_id]
        half = len(t) // 2
        assert r.n_chars == len(t) and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.doc_id != 9:  # of two equal rows one is followed by the other
            assert r.edited_sha256 == hashlib.sha256((t[: len(t) - half] + follows[r.doc_id][:half]).encode()).hexdigest()
    marks = {r.doc_id: r.fingerprint for r in got}
    assert marks[5] == marks[6] == marks[None] and marks[0] == marks[1] == "3::"
    assert fingerprint.likeness(marks[5], marks[7]) > 0.8 and fingerprint.likeness(marks[5], marks[11]) < 0.5
    assert {r.doc_id: r.fingerprint for r in fingerprint.fingerprint_documents(docs_of(spark, rows)).collect()} == marks


@pytest.mark.parametrize("passage", [20, 37, 100, 260, 1000])
def test_fingerprint_of_long_periodic_texts(passage):
    rng = random.Random(passage)
    draw = lambda n: "".join(rng.choice("abcdefghij klmnop") for _ in range(n))
    mark = lambda t: fingerprint.fingerprint(fingerprint.code_points(t))
    text = (draw(passage) * 40000)[:40000]
    half = text[:20000] + draw(20000)
    tail = text[:38000] + draw(2000)
    size = len(mark(text).split(":")[1])
    assert 16 <= size <= 97
    assert 0 <= fingerprint.likeness(mark(text), mark(half)) < 0.9
    assert fingerprint.likeness(mark(text), mark(tail)) > 0.5
    assert fingerprint.likeness(mark(text), mark(draw(40000))) < 0.3


def test_mixing(spark):
    rows = odd_texts() + [(100 + i, f"t{i}", "big") for i in range(300)] + [(500 + i, "x", "few") for i in range(3)]
    docs = docs_of(spark, rows)
    key = lambda r: (str(r.doc_id), r.copy_no)
    got = sorted(mixing.mix(docs, {"big": 1.0, "few": 1.0, None: 0.0}).collect(), key=key)
    counts = {s: sum(r.source == s for r in got) for s in ("big", "few", "a", None)}
    assert counts["a"] == counts[None] == 0 and 100 < counts["big"] < 230 and 100 < counts["few"] < 230  # means of 159.5, 53 a row
    salted = sorted(mixing.mix(docs, {"big": 1.0, "few": 1.0, None: 0.0}, max_broadcast=0).collect(), key=key)
    assert [key(r) for r in got] == [key(r) for r in salted]
    assert mixing.mix(docs.limit(0)).count() == 0
    assert set(mixing.mix(docs).columns) == set(docs.columns) | {"mix_key"}


def test_lines(spark):
    rows = [(i, f"Menu \nown {i}\n\nMenu", "h" if i < 8 else "k") for i in range(12)] + [(20, None, "h"), (21, "", "h"), (22, "Menu", None), (22, "Menu", None)]
    for limit in (10, 0):
        got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in lines.drop_boilerplate_lines(docs_of(spark, rows), max_broadcast=limit).collect()}
        assert got[0] == ("own 0\n", 4, 2)
        assert got[9] == (rows[9][1], 4, 0)  # four pages are too few
        assert got[20] == (None, 0, 0) and got[21] == ("", 1, 0) and got[22] == ("Menu", 1, 0)
    assert lines.drop_boilerplate_lines(docs_of(spark, rows).limit(0)).count() == 0


def test_lines_drop_boilerplate_of_a_few_per_cent(spark):
    rows = [(i, f"own {i}\n" + "".join(f"on {k}\n" for k in (5, 10, 15) if i % 100 < k) + ("rare\n" if i < 4 else "") + "end", f"h{i % 2}") for i in range(400)]
    rows = [(i, t.removesuffix("\nend"), h) for i, t, h in rows] + [(1000 + i, f"own {i}" + "\nshort" * (i < 4), "small") for i in range(20)]
    got = {r.doc_id: r.text for r in lines.drop_boilerplate_lines(docs_of(spark, rows)).collect()}
    assert got == {i: "\n".join(x for x in t.split("\n") if not x.startswith("on ")) for i, t, _ in rows}  # "rare" and "short" are on under five pages


def test_topk_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=8)], 0) for i in range(400)]
    rows += [(400, rows[7][1], 0), (401, rows[7][1], 0), (500, [0.0] * 8, 0), (600, None, 0), (700, [math.nan] * 8, 0), (701, [None, 1.0], 0), (None, [1.0] * 8, 0), (800, [0.5, 0.25], 0)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score int")
    v = [(i, np.floor(1024 * np.pad(np.float32(x).astype(float), (0, 8 - len(x))))) for i, x, _ in rows if i is not None and x and all(y is not None and math.isfinite(y) for y in x)]
    want = []
    for q, x in v:
        if q % 100 == 0:
            best = sorted((-int(x @ y), i) for i, y in v if i != q)[:10]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    rows_ = df.filter(topk.usable(df.embedding)).select("vec_id", topk.quantised(df.embedding).alias("q"))
    small = topk.search(rows_, rows_.filter("vec_id % 100 = 0"), 10, shard_rows=60, query_rows=2)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, topk.search_table(df).collect())) == sorted(want)
    assert topk.search_table(df.limit(0)).count() == 0


def test_quality_and_toxicity(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    rows, labels = [], []
    for i in range(700):
        w = [rng.choice(words) for _ in range(rng.randint(30, 80))]
        bad, toxic = i % 5 == 0, i % 4 == 0
        w = [x + "!!" for x in w] if bad else w
        if toxic:
            for k in range(rng.randint(1, 4)):
                w[rng.randrange(len(w))] = rng.choice(["scoundrel", "wretch", "vermin"])
        rows.append((i, " ".join(w), "s"))
        labels.append((i, None if i == 3 else int(not bad), int(toxic)))
    df, lab = docs_of(spark, rows + odd_texts()[:3]), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = quality.score(df, quality.fit(df, lab)).collect()
    truth = {i: q for i, q, _ in labels}
    held = [r for r in got if r.held_out and truth[r.doc_id] is not None]
    assert len(got) == 703 and all(0 <= r.score <= 1 for r in got) and sum(r.predicted == truth[r.doc_id] for r in held) > 0.9 * len(held)
    model = toxicity.fit(df, lab)
    assert (np.diff(model.thresholds) > 0).all() and len(model.thresholds) == 2
    marks = toxicity.score(df, model)
    assert set(marks.columns) == set(df.columns) | {"p_toxic", "grade", "rejected"}
    truth = {i: t for i, _, t in labels}
    import zlib

    held = [r for r in marks.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert sum(r.rejected == (truth[r.doc_id] == 1) for r in held) > 0.9 * len(held)
    empty = docs_of(spark, []) if False else df.limit(0)
    assert quality.score(empty, quality.fit(df, lab.limit(0))).count() == 0
    assert toxicity.score(df, toxicity.fit(df, lab.limit(0))).filter("rejected").count() == 0


def test_ordinal_weights_are_shared_and_thresholds_ordered():
    rng = np.random.default_rng(1)
    x = rng.normal(size=600)
    grade = np.digitize(2 * x + rng.logistic(size=600), [-1, 1.5])
    w, theta = toxicity.fit_ordinal([([0], [v]) for v in x], grade, 1, ridge=0.0)
    assert 1.5 < w[0] < 2.5 and -1.5 < theta[0] < -0.5 and 1.0 < theta[1] < 2.0


HTML = {
    "plain &amp; text": "plain & text",
    "": "",
    None: "",
    '<body><nav><a href=x>Home</a></nav><article><h1>T &lt;1&gt;</h1><p>a<b>b</b>c &nbsp; d<br>e<p>next<ul><li>x<li>y</ul></article><footer>f</footer></body>': "T <1>\nabc d e\nnext\nx\ny",
    '<div class="sidebar"><p>' + "side " * 50 + '</p></div><div id="x"><h1>Head</h1><div><p>' + "one " * 40 + "</p><p>" + "two " * 30 + '</p></div></div><div class="comments"><p>' + "nice " * 90 + "</p></div><form>" + "f " * 90 + "</form>": "Head\n" + ("one " * 40).strip() + "\n" + ("two " * 30).strip(),
    '<script>var t="</p>";</script><!-- c --><p>' + "word " * 20 + "<p>" + "more " * 20: ("word " * 20).strip() + "\n" + ("more " * 20).strip(),
    "<nav><a>only menu</a></nav>": "",
}


def test_html(spark):
    rows = [(i, f"u{i}", h, "clash") for i, h in enumerate(HTML)]
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")).collect()}
    for (i, u, h, _) in rows:
        assert got[i] == (u, HTML[h], len(HTML[h]))


ONE, TWO, SIDE = ("one " * 40).strip(), ("two " * 30).strip(), ("side " * 50).strip()


@pytest.mark.parametrize("wrapper", ["class='layout has-sidebar'", "class='no-sidebar'", "class='content comments-open'", "class='page legal'", "id='search-results'", "class='layout--sidebar'"])
@pytest.mark.parametrize("inner", ["article", "main", "div"])
def test_html_keeps_wrappers_that_hold_the_article(wrapper, inner):
    page = f"<body><div {wrapper}><div class='sidebar-left'><p>{SIDE}</p></div><{inner}><h1>Head</h1><p>{ONE}</p><p>{TWO}</p></{inner}></div><div class='site-comments'><p>{SIDE}</p></div></body>"
    assert html_text.main_text(page) == f"Head\n{ONE}\n{TWO}"


def test_html_names_inside_articles():
    body = f"<h1>Head</h1><h2 id='related-work'>Related work</h2><p class='notice'>{ONE}</p><h2 class='search' id='search'>Search</h2><p>{TWO}</p>"
    want = f"Head\nRelated work\n{ONE}\nSearch\n{TWO}"
    for inner in ("article", "main", "div"):
        assert html_text.main_text(f"<{inner}>{body}</{inner}><p class='copyright'>{SIDE}</p>") == want
    sections = f"<article><h1>Head</h1><section id='notice'><h2>A</h2><p>{ONE}</p></section><div class='section' id='search'><p>{TWO}</p></div><div class='share-buttons'>{SIDE}</div></article>"
    assert html_text.main_text(sections) == f"Head\nA\n{ONE}\n{TWO}"
    assert html_text.main_text(f"<article><p>{TWO}</p></article><div class='ad'>{SIDE} {SIDE} {SIDE}</div>") == TWO
    comments = "".join(f"<li><article class='comment'><p>{SIDE}</p></article></li>" for _ in range(2))
    assert html_text.main_text(f"<main><article><p>{ONE}</p></article><ol class='comment-list'>{comments}</ol></main>") == ONE


@pytest.mark.parametrize("start", ["<body>", "", "<p>", "text "])
def test_html_head_left_open(start):
    page = f"<!doctype html><html><head><meta charset=utf-8><title>t</title><style>p{{}}</style><link rel=x>\n{start}<article><h1>Head</h1><p>{ONE}</article>"
    assert html_text.main_text(page) == f"Head\n{ONE}"
    assert html_text.main_text(page.replace("<article>", "<head><article>")) == f"Head\n{ONE}"


def test_html_beside_the_densest_article():
    both = f"<article><p>{ONE}</p><p>{ONE}</p><p>{ONE}</p></article><article><p>{TWO}</p></article>"
    text = f"Title\n{ONE}\n{ONE}\n{ONE}\n{TWO}"
    links = "<ul>" + "<li><a href=x>other page</a></li>" * 9 + "</ul>"
    for title in ("<h1>Title</h1>", "<header><h1>Title</h1><a href=x>Topic</a></header>"):
        assert html_text.main_text(f"<body><h1>Site</h1><main>{title}{both}{links}</main><article>{SIDE}</article></body>") == text
    assert html_text.main_text(f"<body><div>{links}<h1>Title</h1>{both}</div></body>") == text
    assert html_text.main_text(f"<body><h1>Site</h1><article><h1>Title</h1><p>{ONE}</p><p>{ONE}</p><p>{ONE}</p></article><div>{TWO}</div></body>") == text.removesuffix(f"\n{TWO}")


def test_empty_tables(spark):
    empty = docs_of(spark, odd_texts()).limit(0)
    assert substrings.remove_repeats(empty).count() == 0
    assert jaccard.near_duplicates(empty).count() == 0
    assert bpe.digest_documents(empty).count() == 0
    assert fingerprint.compare_with_next(empty).count() == 0


def test_jaccard_sieve_keeps_every_possible_partner():
    rng = random.Random(12)
    base = [np.unique(np.array([rng.getrandbits(64) for _ in range(rng.choice([1, 3, 40, 70, 120, 260, 500]))], np.uint64)) for _ in range(30)]
    sets = []
    for s in base:
        sets.append(s)
        for _ in range(rng.randint(0, 4)):
            keep = np.array([x for x in s.tolist() if rng.random() > 0.06] or s[:1].tolist(), np.uint64)
            sets.append(np.unique(np.concatenate([keep, np.array([rng.getrandbits(64) for _ in range(len(s) // 20)], np.uint64)])))
    n, marks = np.array([len(s) for s in sets]), [jaccard.sketch(s) for s in sets]
    for comps, blocks in ((list(range(len(sets))), [0] * len(sets)), ([i // 3 for i in range(len(sets))], [i % 2 for i in range(len(sets))])):
        got = jaccard.partners(n, np.array(comps), np.array(blocks), marks)
        apart = len(set(blocks)) > 1
        pairs = [(i, j) for i in range(len(sets)) for j in range(i) if comps[i] != comps[j] and (not apart or blocks[i] != blocks[j])]
        want = {x for i, j in pairs if jaccard.may_link(int(n[i]), marks[i], int(n[j]), marks[j]) for x in (i, j)}
        assert set(np.flatnonzero(got).tolist()) == want
        assert {x for i, j in pairs if jaccard.linked(sets[i], sets[j]) for x in (i, j)} <= want and len(want) < len(sets)


@pytest.mark.parametrize("sieved,tile", [(60, 400), (32_768, 200_000)])
def test_jaccard_large_groups_in_many_blocks(spark, monkeypatch, sieved, tile):
    """Hundreds of near copies and of texts that only share a common part: blocks of any size find the same."""
    monkeypatch.setattr(jaccard, "SIEVED", sieved)
    monkeypatch.setattr(jaccard, "TILE", tile)
    rng = random.Random(13)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(120)]
    rows = []
    for i in range(240):
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((i, " ".join(w), "a"))
    rows += [(1000 + i, " ".join(base[:60] + [rng.choice(words) for _ in range(60)]), "b") for i in range(60)]
    got = jaccard.near_duplicates(docs_of(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_components(rows)


@pytest.mark.parametrize("origin,windows", [(2000, 1_000_000), (7, 50)])
def test_substrings_hot_passage_and_near_copies(spark, monkeypatch, origin, windows):
    """A passage in hundreds of documents with other words around it, and hundreds of near copies of one text."""
    monkeypatch.setattr(substrings, "ORIGIN", origin)
    monkeypatch.setattr(substrings, "BUCKET_WINDOWS", windows)
    rng = random.Random(21)
    words = [f"w{i}" for i in range(3000)]
    passage, base = [rng.choice(words) for _ in range(70)], [rng.choice(words) for _ in range(90)]
    rows = [(i, " ".join([rng.choice(words) for _ in range(30)] + passage + [rng.choice(words) for _ in range(30)]), "a") for i in range(320)]
    for i in range(300):
        w = list(base)
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((400 + i, " ".join(w), "b"))
    got = substrings.remove_repeats(docs_of(spark, rows).repartition(6), digest=True, shard_contexts=20)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_windows(rows, 50)


def test_jaccard_packed_signatures():
    rng = np.random.default_rng(3)
    ids = np.sort(rng.integers(-(2**62), 2**62, 500))
    assert (np.cumsum(jaccard._restored(jaccard._squeezed(np.diff(ids, prepend=0)))) == ids).all()
    kinds = (rng.integers(0, 900, 500) << 33) + (rng.integers(0, 2000, 500) << 2) + 1
    assert (jaccard._restored(jaccard._squeezed(kinds)) == kinds).all()
    sigs = rng.integers(0, 2**48, 500, dtype=np.uint64)
    assert (jaccard._widened(jaccard._narrow(sigs)) == sigs).all() and len(jaccard._narrow(sigs)) == 3000
