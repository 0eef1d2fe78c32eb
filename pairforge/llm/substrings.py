"""Substring dedup by suffix automata over reference shards.

A window is WIDTH consecutive words.  Every window has a key: the least hash of the word K-grams in
it, which equal windows share.  Consecutive windows of one key form a run, and the words of a run
its context.  The distinct contexts of one key, each with the smallest id that holds it, are a
reference shard: its contexts enter a suffix automaton in ascending order of id, so that each state
knows the smallest id it occurs in, and every context is first streamed through the automaton of
those before it.  Where the matching statistic reaches WIDTH, the window also starts in a smaller id.

Shards of the whole corpus grow with it, so neither they nor the tables of shared keys are
broadcast (the joins carry a merge hint and move alike at every size): keys found in one document
only are dropped first, and a shard travels with the contexts that can match it through one shuffle
by key.  A key with more than SHARD_CONTEXTS distinct contexts (a passage that very many documents
share, with other words around it) takes an exact way of its own: its contexts are dealt over tasks,
which exchange digests of their distinct windows for the smallest id of each (``_hot_spans``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import materialize, shuffle_width
from pairforge.llm.words import gram_hashes, word_hashes

WIDTH, K, SHARD_CONTEXTS = 50, 8, 256
#: Contexts of very frequent keys in one origin, and windows in one bucket.
ORIGIN, BUCKET_WINDOWS = 2000, 1_000_000
_FAR = 2**63 - 1


def window_keys(words: np.ndarray, width: int = WIDTH, k: int = K) -> np.ndarray:
    """The key of each window, in order."""
    n = len(words)
    if n < width:
        return np.empty(0, np.int64)
    least, span, want = gram_hashes(words, k), 1, width - k + 1
    while span < want:  # least of twice as many grams, or of as many more as are wanted
        step = min(span, want - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    return least.view(np.int64)


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first window, number of windows) of each run of one key."""
    if not len(keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return first, np.diff(np.concatenate([first, [len(keys)]]))


class Automaton:
    """Suffix automaton of word sequences that are added in ascending order of their owner."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.owner = [-1], [0], [_FAR]

    def _state(self, following: dict, link: int, length: int, owner: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.owner.append(owner)
        return len(self.link) - 1

    def _split(self, p: int, q: int, word) -> int:
        """The state for ``p`` followed by ``word``, cut out of ``q`` where that is longer."""
        if self.length[p] + 1 == self.length[q]:
            return q
        clone = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1, self.owner[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list, owner: int) -> None:
        last = 0
        for w in words:
            q = self.next[last].get(w)
            if q is not None:
                last = self._split(last, q, w)
                continue
            new, p = self._state({}, 0, self.length[last] + 1, owner), last
            while p >= 0 and w not in self.next[p]:
                self.next[p][w] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, self.next[p][w], w)
            last = new

    def covered(self, words: list, owner: int, width: int) -> list[int]:
        """Windows of ``words`` that also occur with a smaller owner, by streaming the words once."""
        out, v, matched = [], 0, 0
        nxt, link, length = self.next, self.link, self.length
        for i, w in enumerate(words):
            while v and w not in nxt[v]:
                v = link[v]
                matched = length[v]
            if w in nxt[v]:
                v = nxt[v][w]
                matched += 1
            else:
                matched = 0
            if matched >= width:
                while length[link[v]] >= width:
                    v = link[v]
                    matched = length[v]
                if self.owner[v] < owner:
                    out.append(i - width + 1)
        return out


def _contexts(width: int, with_text: bool):
    names = ["key", "c1", "c2", "_d", "_h", "start", "n"] + ["ctx"] * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d, h = b.column("_d").to_pylist(), b.column("_h").to_pylist()
            out: list[tuple] = []
            size = 0
            for r in range(b.num_rows):
                raw = b.column("text")[r].as_py().encode()
                words = raw.split()
                keys = window_keys(word_hashes(raw), width)
                first, n = runs(keys)
                wanted = np.isin(keys[first], np.asarray(b.column("keys")[r].values, dtype=np.int64))
                for s, c in zip(first[wanted].tolist(), n[wanted].tolist(), strict=True):
                    ctx = b" ".join(words[s : s + c + width - 1])
                    digest = xxhash.xxh3_128_digest(ctx)
                    c1, c2 = int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)
                    out.append((int(keys[s]), c1, c2, d[r], h[r], s, c, ctx))
                    size += len(ctx) if with_text else 60
                if size > 1 << 23:
                    yield _batch(out, names)
                    out, size = [], 0
            if out:
                yield _batch(out, names)

    return run


_KINDS = {"key": pa.int64(), "c1": pa.int64(), "c2": pa.int64(), "_d": pa.int64(), "_h": pa.int64(), "start": pa.int32(), "n": pa.int32(), "ctx": pa.binary(), "first": pa.int64(), "spans": pa.list_(pa.int32())}
_SQL = {"key": "bigint", "c1": "bigint", "c2": "bigint", "_d": "bigint", "_h": "bigint", "start": "int", "n": "int", "ctx": "binary", "first": "bigint", "spans": "array<int>"}


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [()] * 99
    return pa.record_batch([pa.array(cols[i], _KINDS[c]) for i, c in enumerate(names)], names)


def _schema(names: list[str]) -> str:
    return ", ".join(f"{c} {_SQL[c]}" for c in names)


def _spans(windows: list[int]) -> list[int]:
    """Ascending windows as pairs (first, number)."""
    out: list[int] = []
    for w in windows:
        if out and out[-2] + out[-1] == w:
            out[-1] += 1
        else:
            out += [w, 1]
    return out


def _stream_shards(width: int):
    """Rows sorted by (key, first): one automaton per key, built when its second context comes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, automaton, waiting = None, None, None
        for b in batches:
            out = []
            for k, c1, c2, d, ctx in zip(*(b.column(c).to_pylist() for c in ("key", "c1", "c2", "first", "ctx")), strict=True):
                words = ctx.split()
                if k != key:
                    key, automaton, waiting = k, None, (words, d)
                    continue
                if automaton is None:
                    automaton = Automaton()
                automaton.add(*waiting)
                got = automaton.covered(words, d, width)
                if got:
                    out.append((k, c1, c2, d, _spans(got)))
                waiting = (words, d)
            if out:
                yield _batch(out, ["key", "c1", "c2", "first", "spans"])

    return run


def _digests(ctx: bytes, width: int) -> list[bytes]:
    """A 128-bit digest of each window of a context, whose words are joined by one space."""
    gap = np.flatnonzero(np.frombuffer(ctx, np.uint8) == 32)
    start, end = [0, *(gap + 1).tolist()], [*gap.tolist(), len(ctx)]
    return [xxhash.xxh3_128_digest(ctx[a:b]) for a, b in zip(start, end[width - 1 :], strict=False)]


_DIGEST = np.dtype([("hi", "<u8"), ("lo", "<u8")])
_ENTRY = {"bucket": pa.int64(), "origin": pa.int64(), "digests": pa.binary(), "low": pa.binary(), "high": pa.binary()}
_ENTRIES = "bucket bigint, origin bigint, digests binary, low binary, high binary"


def _entries(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ENTRY.values(), strict=True)], list(_ENTRY))


def _window_owners(width: int, buckets: int):
    """Rows sorted by origin: of each origin's distinct windows the smallest and largest id, packed by bucket."""

    def packed(origin: int, ends: dict[bytes, tuple[int, int]]) -> pa.RecordBatch:
        digests = np.frombuffer(b"".join(ends), _DIGEST)
        low, high = (np.array(x, np.int64) for x in zip(*ends.values(), strict=True))
        bucket = (digests["lo"].astype(np.uint64) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
        parts = [order[x:y] for x, y in zip(edges[:-1], edges[1:], strict=True)]
        return _entries([(int(bucket[p[0]]), origin, digests[p].tobytes(), low[p].tobytes(), high[p].tobytes()) for p in parts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        origin, ends = None, {}
        for b in batches:
            for o, d, ctx in zip(*(b.column(c).to_pylist() for c in ("origin", "first", "ctx")), strict=True):
                if o != origin and ends:
                    yield packed(origin, ends)
                    ends = {}
                origin = o
                for x in _digests(ctx, width):
                    low, high = ends.get(x, (d, d))
                    ends[x] = (min(low, d), max(high, d))
        if ends:
            yield packed(origin, ends)

    return run


def _least_owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: the smallest id of each window that several ids have, to every origin that has
    it with a larger one (``low`` is the smallest id of all; ``high`` goes unused)."""

    def answers(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        digests = np.concatenate([np.frombuffer(h[2], _DIGEST) for h in held])
        low, high = (np.concatenate([np.frombuffer(h[i], np.int64) for h in held]) for i in (3, 4))
        origin = np.repeat([h[1] for h in held], [len(h[2]) // 16 for h in held])
        order = np.lexsort((digests["lo"], digests["hi"]))
        digests, low, high, origin = digests[order], low[order], high[order], origin[order]
        first = np.flatnonzero(np.concatenate([[True], digests[1:] != digests[:-1]]))
        least = np.repeat(np.minimum.reduceat(low, first), np.diff(np.append(first, len(low))))
        hit = np.flatnonzero(high > least)
        hit = hit[np.argsort(origin[hit], kind="stable")]
        edges = np.flatnonzero(np.diff(origin[hit], prepend=-1, append=-1))
        parts = [hit[x:y] for x, y in zip(edges[:-1], edges[1:], strict=True)]
        if parts:
            yield _entries([(held[0][0], int(origin[p[0]]), digests[p].tobytes(), least[p].tobytes(), b"") for p in parts])

    held: list[tuple] = []
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in _ENTRY), strict=True):
            if held and row[0] != held[0][0]:
                yield from answers(held)
                held = []
            held.append(row)
    if held:
        yield from answers(held)


def _look_up(width: int):
    """Rows sorted by (origin, ctx; nulls first): an origin's answers, then its contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        origin, least = None, {}
        for b in batches:
            out = []
            for o, digests, low, k, c1, c2, d, ctx in zip(*(b.column(c).to_pylist() for c in ("origin", "digests", "low", "key", "c1", "c2", "first", "ctx")), strict=True):
                if o != origin:
                    origin, least = o, {}
                if ctx is None:
                    least.update(zip((digests[i : i + 16] for i in range(0, len(digests), 16)), np.frombuffer(low, np.int64).tolist(), strict=True))
                    continue
                got = [i for i, x in enumerate(_digests(ctx, width)) if least.get(x, d) < d]
                if got:
                    out.append((k, c1, c2, d, _spans(got)))
            if out:
                yield _batch(out, ["key", "c1", "c2", "first", "spans"])

    return run


def _hot_spans(hot: DataFrame, width: int, found: list[str]) -> DataFrame:
    """Spans of the contexts (key, c1, c2, first, ctx) of keys that very many contexts share.

    Contexts are dealt into origins of about ORIGIN of them.  Each origin sends its distinct windows, packed by
    bucket, with the smallest and largest id that it has for them; a bucket finds each window's smallest id of all
    and answers the origins that hold it with a larger one; origins look up their own windows.  A window that all
    contexts share is one entry an origin, so traffic is linear in the contexts and no key's windows meet in one
    task as a whole.
    """
    cores, n = shuffle_width(hot.sparkSession), hot.count()
    buckets = max(cores, -(-n * (width - K + 1) // BUCKET_WINDOWS))
    placed = hot.withColumn("origin", F.pmod(F.xxhash64("key", "c1", "c2"), F.lit(max(1, -(-n // ORIGIN)))))
    sent = placed.select("origin", "first", "ctx").repartition(cores, "origin").sortWithinPartitions("origin").mapInArrow(_window_owners(width, buckets), _ENTRIES)
    answers = sent.repartition(cores, "bucket").sortWithinPartitions("bucket").mapInArrow(_least_owners, _ENTRIES)
    both = answers.select("origin", "digests", "low").unionByName(placed, allowMissingColumns=True)
    return both.repartition(cores, "origin").sortWithinPartitions("origin", F.col("ctx").asc_nulls_first()).mapInArrow(_look_up(width), _schema(found))


def removed_ranges(candidates: DataFrame, width: int, shard_contexts: int) -> DataFrame:
    """(_d, _h, ranges): word ranges to remove of each candidate document (columns _d, _h, text, keys)."""
    names = ["key", "c1", "c2", "_d", "_h", "start", "n"]
    with_text = candidates.select("_d", "_h", "text", "keys").mapInArrow(_contexts(width, True), _schema([*names, "ctx"]))
    places = candidates.select("_d", "_h", "text", "keys").mapInArrow(_contexts(width, False), _schema(names))
    distinct = with_text.groupBy("key", "c1", "c2", "ctx").agg(F.min("_d").alias("first"), F.max("_d").alias("last"))
    distinct = materialize(distinct, "contexts")
    many = materialize(distinct.groupBy("key").agg(F.count(F.lit(1)).alias("_contexts")).filter("_contexts > 1"), "shards")
    met = distinct.select("key", "c1", "c2", "first", "ctx").join(many.hint("merge"), "key")
    found = ["key", "c1", "c2", "first", "spans"]
    shards = met.filter(F.col("_contexts") <= shard_contexts).repartition(shuffle_width(candidates.sparkSession), "key").sortWithinPartitions("key", "first")
    streamed = shards.select("key", "c1", "c2", "first", "ctx").mapInArrow(_stream_shards(width), _schema(found))
    hot = materialize(met.filter(F.col("_contexts") > shard_contexts).select("key", "c1", "c2", "first", "ctx"), "hot-contexts")
    looked_up = _hot_spans(hot, width, found)
    whole = distinct.filter(F.col("first") < F.col("last")).select("key", "c1", "c2", "first", F.lit(None).cast("array<int>").alias("spans"))
    # spans: for the smallest id that holds the context; without: for all other ids, the whole run
    verdicts = materialize(whole.union(streamed).union(looked_up), "verdicts")
    hit = places.join(verdicts.hint("merge"), ["key", "c1", "c2"]).filter(F.expr("(spans IS NULL AND _d > first) OR (spans IS NOT NULL AND _d = first)"))
    whole_run = F.array(F.col("start"), F.col("start") + F.col("n") + F.lit(width - 1))
    part = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("spans") - 2, F.lit(0)), F.lit(2)),
        lambda i: F.array(F.col("start") + F.col("spans")[i], F.col("start") + F.col("spans")[i] + F.col("spans")[i + 1] + F.lit(width - 1)),
    )
    ranges = F.when(F.col("spans").isNull(), F.array(whole_run)).otherwise(part)
    return hit.select("_d", "_h", ranges.alias("r")).groupBy("_d", "_h").agg(F.flatten(F.collect_list("r")).alias("ranges"))


_FINAL = ["doc_id", "n_words", "n_removed", "kept_sha256"]


def _result(ids: pa.Array, texts: list, ranges: list, with_text: bool) -> pa.RecordBatch:
    n_words, n_removed, digests, kept_texts = [], [], [], []
    for t, r in zip(texts, ranges, strict=True):
        words = (t or "").encode().split()
        if r is not None and len(r):
            at = np.asarray(r, dtype=np.int64)
            gone = np.zeros(len(words) + 1, np.int64)
            np.add.at(gone, at[:, 0], 1)
            np.add.at(gone, at[:, 1], -1)
            keep = np.flatnonzero(np.cumsum(gone)[:-1] == 0).tolist()
            kept = [words[i] for i in keep]
        else:
            kept = words
        joined = b" ".join(kept)
        n_words.append(len(words))
        n_removed.append(len(words) - len(kept))
        digests.append(joined.decode() if with_text else hashlib.sha256(joined).hexdigest())
    cols = [ids, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())]
    return pa.record_batch(cols, [*_FINAL[:3], "kept"])


def remove_repeats(docs: DataFrame, *, width: int = WIDTH, shard_contexts: int = SHARD_CONTEXTS, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words joined by one space (``kept``, or with ``digest`` their ``kept_sha256``).

    Words are ``[^\\x20\\x09-\\x0D]+``.  Each word goes that is covered by a window of ``width`` words
    whose word sequence also starts in a row with a smaller doc_id; windows are judged on the
    input.  A null text has no words; a text under ``width`` words loses none.  A null doc_id is
    larger than any other.  Rows with one doc_id don't remove each other's words; repeated rows
    give repeated results.  Only doc_id and text are read.  An empty table gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("_d", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_FAR))).withColumn("_h", F.xxhash64("text"))

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [np.unique(window_keys(word_hashes(t.encode()), width)) for t in b.column("text").to_pylist()]
            n = [len(g) for g in got]
            at = np.repeat(np.arange(b.num_rows), n)
            yield pa.record_batch([pa.array(np.concatenate([np.empty(0, np.int64), *got])), b.column("_d").take(pa.array(at)), b.column("_h").take(pa.array(at))], ["key", "_d", "_h"])

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents without a shared key are done; the others keep their text."""
        for b in batches:
            done = b.filter(pc.is_null(b.column("keys")))
            open_ = b.filter(pc.is_valid(b.column("keys")))
            got = _result(done.column("doc_id"), done.column("text").to_pylist(), [None] * done.num_rows, not digest)
            null = lambda t, n: pa.nulls(n, t)
            n = done.num_rows
            yield pa.record_batch([*got.columns, null(pa.string(), n), null(pa.int64(), n), null(pa.int64(), n), null(pa.list_(pa.int64()), n)], mixed)
            n = open_.num_rows
            keys = open_.column("keys").cast(pa.list_(pa.int64()))
            yield pa.record_batch([open_.column("doc_id"), null(pa.int64(), n), null(pa.int64(), n), null(pa.string(), n), open_.column("text"), open_.column("_d"), open_.column("_h"), keys], mixed)

    def last_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _result(b.column("doc_id"), b.column("text").to_pylist(), b.column("ranges").to_pylist(), not digest)

    mixed = ["doc_id", "n_words", "n_removed", "kept", "text", "_d", "_h", "keys"]
    final = f"doc_id {kind}, n_words bigint, n_removed bigint, kept string"
    keys = materialize(rows.select("text", "_d", "_h").mapInArrow(keys_of, "key bigint, _d bigint, _h bigint"), "window-keys")
    shared = materialize(keys.groupBy("key").agg(F.min("_d").alias("a"), F.max("_d").alias("b")).filter("a < b").select("key"), "shared-keys")
    by_doc = keys.join(shared.hint("merge"), "key", "left_semi").groupBy("_d", "_h").agg(F.collect_set("key").alias("keys"))
    first = rows.join(by_doc.hint("merge"), ["_d", "_h"], "left").select("doc_id", "text", "_d", "_h", "keys")
    first = materialize(first.mapInArrow(first_pass, f"{final}, text string, _d bigint, _h bigint, keys array<bigint>"), "screened")
    candidates = first.filter(F.col("_d").isNotNull())
    ranges = removed_ranges(candidates, width, shard_contexts)
    rest = candidates.select("doc_id", "text", "_d", "_h").join(ranges.hint("merge"), ["_d", "_h"], "left").select("doc_id", "text", "ranges").mapInArrow(last_pass, final)
    out = first.filter(F.col("_d").isNull()).select("doc_id", "n_words", "n_removed", "kept").union(rest)
    return out.withColumnRenamed("kept", "kept_sha256") if digest else out
