"""N-gram Jaccard join by universe partition and pigeonhole.

A document is the set of its word shingles.  If two sets of sizes a and b reach the threshold, at
most ``d = (1 - t) / (1 + t) * (a + b)`` shingles differ.  The universe is hashed into segments, as
many as the size band asks for.  The content of a segment is a signature; of a segment with several
shingles the contents with one of them deleted are signatures too.  Segments without a common
signature differ in one shingle at least, and in two if one of them has several: a segment pays 1
or 2.  Each set walks its segments that are not empty in one global order and indexes them until it
has paid for more than its largest possible d; then two sets that link meet in the shorter walk:

* shingles of few documents come first, in fine segments with about one shingle each;
* shingles of very many documents come last, in coarse segments, by classes of frequency.

This is the cost-based allocation: a signature is bought where the fewest sets are expected to hold
it.  A set that runs out of segments also indexes single shingles in the same order, which pay 1
each.  A pair meets in the band of its larger set; a set near a band's end also walks the next band.

Sets a and b with Ra and Rb fine segments differ in at least Ra + Rb shingles if no fine signature
is common: a segment that only one of them has costs 1, one that both have costs 2.  So a pair
that meets in coarse segments only counts if Ra + Rb <= d, which needs a set with
R <= d / 2, a light one: groups of coarse segments without a light set make no candidates, and in the
others every candidate has one.

Candidates first pass a parity sketch: bit i of a set's sketch is the parity of its shingles that
hash to i, so the bits in which two sketches differ are at most the shingles in which the sets do.
What is left is verified on the texts.  Links within a group of sets that share a signature are found
without all its pairs: first each set is verified against the smallest of the sets that lead its
groups, then against the others that are not connected to it yet.  At last the members of groups
that still span several components are compared in tasks of two blocks, which send on a forest of
links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import in_stage, materialize, shuffle_width
from pairforge.llm.words import gram_hashes, mix, word_hashes
from pairforge.session import discard

SHINGLE = 5
#: The threshold is NUM / DEN; two sets differ in at most (a + b) * (DEN - NUM) // (DEN + NUM) shingles.
NUM, DEN = 3, 4
#: Sizes of one band grow by this factor.
BAND = 8
#: Shingles counted as frequent: in at least LOCAL sets of one batch and TOTAL in all; the most kept in the list.
LOCAL, TOTAL, MOST_FREQUENT = 2, 8, 100_000
#: Expected sizes of coarse segments; members of a group that a batch sends on before it links them itself.
COARSE, SENT = 32, 16
#: Ids are broadcast to fetch texts up to this many (8 MB).
MAX_BROADCAST_IDS = 1_000_000
#: Shingles in one block of a large group, what a small set counts for at least, and rows compared at once.
TILE, SMALL, COMPARED = 200_000, 64, 256
#: Sketch words in one block of a large group, and compared at once.
SIEVED, SIEVED_AT_ONCE = 32_768, 1 << 21
#: Bits of a signature that are kept; two that differ may get equal, which only adds candidates.
SIGNATURE_BITS = 48
#: Signatures in one task of the grouping, and in one flush of a batch.
SIGNATURES_IN_TASK, FLUSH = 4_000_000, 1_000_000


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the set of SHINGLE-word shingles, A-Z lower-cased; fewer words are one shingle."""
    words = word_hashes((text or "").encode().lower())
    if not len(words):
        return words
    return np.unique(gram_hashes(words, min(SHINGLE, len(words))))


def most_different(a: int, b: int) -> int:
    return (a + b) * (DEN - NUM) // (DEN + NUM)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    if not len(a) or not len(b) or len(a) * DEN < len(b) * NUM or len(b) * DEN < len(a) * NUM:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return DEN * both >= NUM * (len(a) + len(b) - both)


def _walk(tokens: np.ndarray, ranks: np.ndarray, pay: int, scheme: int) -> tuple[np.ndarray, np.ndarray, int, bool]:
    """Signatures of one set in one band's scheme, of fine and of other segments, its number of fine
    segments, and whether it is light.

    ``ranks``: 0, or a class of frequency from 1.  ``pay``: differences to exceed.  A segment of one
    shingle pays 1 with its content; a larger one pays 2 with its content and every one-deletion.
    """
    segments = BAND ** (scheme + 1)
    coarse = max(1, segments // COARSE)
    mixed = mix(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5 + scheme))
    rare = ranks == 0
    class_ = ranks.astype(np.uint64)
    seg = np.where(rare, tokens % np.uint64(segments), (class_ << np.uint64(40)) + tokens % np.uint64(coarse))
    order = np.argsort(seg, kind="stable")
    seg, content, rare = seg[order], mixed[order], rare[order]
    first = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
    count = np.diff(np.concatenate([first, [len(seg)]]))
    fine = int(rare[first].sum())
    light = 2 * fine <= pay
    paid = np.cumsum(1 + (count > 1))
    first = first[: int(np.searchsorted(paid, pay, "right")) + 1]  # until more than pay
    count = count[: len(first)]
    last = int(count.sum())
    tag = mix(seg[first] * np.uint64(2) + np.uint64(1 + (scheme << 52)))
    sums = np.add.reduceat(content[:last], first) + tag
    own = np.repeat(np.arange(len(first)), count)
    several = count[own] > 1
    whole, deleted = mix(sums), mix(sums[own] - content[:last])[several]
    rare_whole, rare_deleted = rare[first], rare[:last][several]
    others = [whole[~rare_whole], deleted[~rare_deleted]]
    if paid[-1] <= pay:  # out of segments: single shingles in the same order
        order = np.lexsort((tokens, ranks))[: pay + 1]
        others.append(mix(mixed[order] + np.uint64(3 + (scheme << 52))))
    return np.concatenate([whole[rare_whole], deleted[rare_deleted]]), np.concatenate(others), fine, light


def signatures(tokens: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All signatures of one set, of its own band and of the next where a partner may be in it, and
    for each what it stands for: 0 a fine segment, 1 another one of a heavy set, 2 of a light set;
    plus 4 times the size of the set and 2 ** 33 times the number of its fine segments."""
    n = len(tokens)
    if not n:
        return tokens, np.empty(0, np.int64)
    band = 0
    while BAND ** (band + 1) <= n:
        band += 1
    end, partner = BAND ** (band + 1), n * DEN // NUM
    walks = [_walk(tokens, ranks, most_different(n, min(partner, end - 1)), band)]
    if partner >= end:
        walks.append(_walk(tokens, ranks, most_different(n, partner), band + 1))
    sigs, kinds = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for rare, others, fine, light in walks:
        for part, kind in ((rare, 0), (others, 2 if light else 1)):
            sigs.append(part)
            kinds.append(np.full(len(part), (fine << 33) + (n << 2) + kind, np.int64))
    sig, first = np.unique(np.concatenate(sigs), return_index=True)
    return sig, np.concatenate(kinds)[first]


def sketch(tokens: np.ndarray) -> bytes:
    """Parities of the shingles by hash, in the least power of two of bits (64 at least) that holds them."""
    bits = max(64, 1 << max(0, len(tokens) - 1).bit_length())
    odd = np.bincount((mix(tokens) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def may_link(na: int, a: bytes, nb: int, b: bytes) -> bool:
    """False only for pairs that cannot reach the threshold."""
    if not na or not nb or na * DEN < nb * NUM or nb * DEN < na * NUM:
        return False
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum()) <= most_different(na, nb)


@in_stage("jaccard")
def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its set's size and 128-bit digest; per batch (doc_id null) its locally frequent shingles."""
    names = ["doc_id", "n", "s1", "s2", "sketch", "token", "sets"]
    for b in batches:
        size, one, two, marks, sets = [], [], [], [], {}
        for t in b.column("text").to_pylist():
            x = shingles(t)
            d = xxhash.xxh3_128_digest(x.tobytes())
            size.append(len(x))
            one.append(int.from_bytes(d[:8], "big", signed=True))
            two.append(int.from_bytes(d[8:], "big", signed=True))
            marks.append(sketch(x) if len(x) else None)
            sets[d] = x
        n = b.num_rows
        yield pa.record_batch([b.column("doc_id"), pa.array(size, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(marks, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names)
        every = np.concatenate([np.empty(0, np.uint64), *sets.values()])
        every.sort()
        far = every[LOCAL - 1 :] == every[: max(0, len(every) - LOCAL + 1)]  # the LOCAL-th of equal ones
        token = np.unique(every[: len(far)][far])
        count = np.searchsorted(every, token, "right") - np.searchsorted(every, token, "left")
        n = len(token)
        null = pa.nulls(n, pa.int64())
        yield pa.record_batch([null, null, null, null, pa.nulls(n, pa.binary()), pa.array(token.view(np.int64)), pa.array(count.astype(np.int64))], names)


def _ranked(frequent: np.ndarray, classes: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return np.zeros(len(tokens), np.int64)
    at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
    return np.where(frequent[at] == tokens, classes[at], 0)


def _squeezed(values: np.ndarray) -> bytes:
    """64-bit numbers as compressed byte planes: ids in order as steps, sizes and kinds, in two or three bytes each."""
    return zstandard.ZstdCompressor(level=1).compress(values.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes())


def _restored(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<i8").astype(np.int64)


def _narrow(sigs: np.ndarray) -> bytes:
    return np.ascontiguousarray(sigs.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : SIGNATURE_BITS // 8]).tobytes()


def _widened(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) * 8 // SIGNATURE_BITS, 8), np.uint8)
    wide[:, : SIGNATURE_BITS // 8] = np.frombuffer(data, np.uint8).reshape(len(wide), -1)
    return wide.reshape(-1).view("<u8").astype(np.uint64)


def _indexed(frequent: np.ndarray, classes: np.ndarray, buckets: int):
    """Blobs of (signature, id) by bucket; groups that are large within a batch are linked to their smallest id here."""

    def flush(sigs: list[np.ndarray], kinds: list[np.ndarray], ids: list[int]) -> Iterator[pa.RecordBatch]:
        if not sigs:
            return
        sig, kind = np.concatenate(sigs) & np.uint64((1 << SIGNATURE_BITS) - 1), np.concatenate(kinds)
        who = np.repeat(np.array(ids, np.int64), [len(s) for s in sigs])
        order = np.lexsort((who, -(kind & 3), sig))  # a light set, or else the smallest id, leads its group
        sig, kind, who = sig[order], kind[order], who[order]
        first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        count = np.diff(np.concatenate([first, [len(sig)]]))
        large = np.repeat(count > SENT, count)
        head = np.zeros(len(sig), bool)
        head[first] = True
        hub = np.repeat(who[first], count)
        lead = np.repeat(kind[first] & 3, count)
        out_b, out_s, out_h, out_i, out_k, out_l = [], [], [], [], [], []
        hub_kind = np.repeat(kind[first], count)

        def cut(rows: np.ndarray, bucket: np.ndarray, with_hub: bool) -> None:
            o = np.lexsort((who[rows], bucket))
            rows, bucket = rows[o], bucket[o]
            if not len(rows):
                return
            at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
            for lo, hi in zip(at[:-1], at[1:], strict=True):
                part = rows[lo:hi]
                out_b.append(int(bucket[lo]))
                out_s.append(_narrow(sig[part]))
                out_h.append(_squeezed(hub[part]) if with_hub else None)
                out_i.append(_squeezed(np.diff(who[part], prepend=0)))
                out_k.append(_squeezed(kind[part]))
                out_l.append(_squeezed(hub_kind[part]) if with_hub else None)

        # a large group is linked to its head here, if that can make candidates of all its pairs
        large &= lead != 1
        sent = np.flatnonzero(~large | head)
        cut(sent, (sig[sent] % np.uint64(buckets)).astype(np.int64), False)
        local = np.flatnonzero(large & ~head)
        cut(local, (mix(who[local].view(np.uint64)) % np.uint64(buckets)).astype(np.int64), True)
        yield pa.record_batch([pa.array(out_b, pa.int32()), pa.array(out_s, pa.binary()), pa.array(out_h, pa.binary()), pa.array(out_i, pa.binary()), pa.array(out_k, pa.binary()), pa.array(out_l, pa.binary())], ["bucket", "sigs", "hubs", "ids", "kinds", "hub_kinds"])

    @in_stage("jaccard")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sigs, kinds, ids, size, seen = [], [], [], 0, set()
            got = sorted(zip(b.column("doc_id").to_pylist(), range(b.num_rows), strict=True))  # the smallest id of equal sets stays
            for d, r in got:
                x = shingles(b.column("text")[r].as_py())
                mark = xxhash.xxh3_128_digest(x.tobytes())
                if not len(x) or mark in seen:
                    continue
                seen.add(mark)
                s, kind = signatures(x, _ranked(frequent, classes, x))
                sigs.append(s)
                kinds.append(kind)
                ids.append(d)
                size += len(s)
                if size > FLUSH:
                    yield from flush(sigs, kinds, ids)
                    sigs, kinds, ids, size = [], [], [], 0
            yield from flush(sigs, kinds, ids)

    return run


@in_stage("jaccard")
def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sig, hub, id, hub_kind, kind) of each signature that more than one id has: every other id with
    the smallest, in groups of other than fine segments with the smallest light one."""
    names = ["sig", "hub", "id", "hub_kind", "kind"]
    sigs, ids, kinds = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for b in batches:
        for s, h, i, k, x in zip(*(b.column(c).to_pylist() for c in ("sigs", "hubs", "ids", "kinds", "hub_kinds")), strict=True):
            sig, who = _widened(s), np.cumsum(_restored(i))
            if h is None:
                sigs.append(sig)
                ids.append(who)
                kinds.append(_restored(k))
            else:
                yield pa.record_batch([pa.array(c) for c in (sig.view(np.int64), _restored(h), who, _restored(x), _restored(k))], names)
    sig, who, kind = np.concatenate(sigs), np.concatenate(ids), np.concatenate(kinds)
    order = np.lexsort((who, -(kind & 3), sig))
    sig, who, kind = sig[order], who[order], kind[order]
    if not len(sig):
        return
    first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
    count = np.diff(np.concatenate([first, [len(sig)]]))
    hub, lead = np.repeat(who[first], count), np.repeat(kind[first], count)
    met = np.flatnonzero((hub != who) & (lead & 3 != 1))
    for lo in range(0, len(met), 1 << 18):
        part = met[lo : lo + (1 << 18)]
        yield pa.record_batch([pa.array(c[part]) for c in (sig.view(np.int64), hub, who, lead, kind)], names)


def components(edges: DataFrame) -> DataFrame:
    """(id, comp) for every id in ``edges`` (a, b): the smallest id connected to it.

    Labels spread along the edges and jump to their label's label; every round is written, so a
    lost executor costs no earlier round.
    """
    edges = materialize(edges.select(F.col("a"), F.col("b")).distinct(), "links")
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = materialize(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("a")).alias("comp")), "labels")
    while True:
        sent = both.join(labels, both["a"] == labels["id"]).select(F.col("b").alias("id"), "comp")
        spread = labels.union(sent).groupBy("id").agg(F.min("comp").alias("comp"))
        spread = materialize(spread, "labels")
        above = spread.select(F.col("id").alias("_up"), F.col("comp").alias("_top"))
        jumped = materialize(spread.join(above, F.col("comp") == F.col("_up")).select("id", F.least("comp", "_top").alias("comp")), "labels")
        old = labels.withColumnRenamed("comp", "_old")
        settled = jumped.join(old, "id").filter("comp <> _old").isEmpty()
        discard(labels, spread)
        if settled:
            discard(edges)
            return jumped
        labels = jumped


def _sizes_allow(x: Column, y: Column) -> Column:
    """Of two kinds: whether sizes, and in coarse segments the shingles in fine ones, let the sets link."""
    n, m = (F.shiftright(k, 2).bitwiseAND(F.lit(2**31 - 1)) for k in (x, y))
    few = (F.shiftright(x, 33) + F.shiftright(y, 33)) * (DEN + NUM) <= (n + m) * (DEN - NUM)
    return (n * DEN >= m * NUM) & (m * DEN >= n * NUM) & ((x.bitwiseAND(F.lit(3)) == 0) | few)


def _sieved(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) that their sketches do not rule out."""

    @in_stage("jaccard")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = zip(*(b.column(c).to_pylist() for c in ("_na", "_sa", "_nb", "_sb")), strict=True)
            yield b.select(["a", "b"]).filter(pa.array([may_link(*x) for x in got], pa.bool_()))

    sa, sb = (sketches.select(F.col("doc_id").alias(x), F.col("n").alias(f"_n{x}"), F.col("sketch").alias(f"_s{x}")) for x in "ab")
    joined = pairs.join(sb.hint("merge"), "b").join(sa.hint("merge"), "a").select("a", "b", "_na", "_sa", "_nb", "_sb")
    return joined.mapInArrow(run, "a bigint, b bigint").distinct()


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold.  Texts of b, one partner each at first, move first."""

    @in_stage("jaccard")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, np.ndarray] = {}
        for b in batches:
            keep = []
            for s, t in zip(b.column("_ta").to_pylist(), b.column("_tb").to_pylist(), strict=True):
                if s not in known:  # sorted by a: one set at a time
                    known = {s: shingles(s)}
                keep.append(linked(known[s], shingles(t)))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    ta, tb = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("_ta")), texts.select(F.col("doc_id").alias("b"), F.col("text").alias("_tb"))
    joined = pairs.join(tb.hint("merge"), "b").join(ta.hint("merge"), "a").select("a", "b", "_ta", "_tb")
    links = materialize(joined.mapInArrow(run, "a bigint, b bigint"), "verified")
    discard(texts)
    return links


def _apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs (a, b) whose components differ; an id without a component is its own."""
    ca, cb = comps.select(F.col("id").alias("a"), F.col("comp").alias("_ca")), comps.select(F.col("id").alias("b"), F.col("comp").alias("_cb"))
    both = pairs.join(ca, "a", "left").join(cb, "b", "left")
    return both.filter(F.coalesce("_ca", "a") != F.coalesce("_cb", "b")).drop("_ca", "_cb")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    A-Z are lower-cased, words are ``[^\\x20\\x09-\\x0D]+``; a document's set holds its distinct
    5-word shingles, or its whole word sequence if that is shorter.  Two documents link when their
    Jaccard similarity is at least 0.75; component_id is the smallest doc_id that links reach.
    Null texts and texts without words have 0 shingles and link with nothing.  Rows with one
    doc_id are one document: they are in one component.  A row with a null doc_id links with nothing
    and has a null component_id.  Only doc_id and text are read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    known = rows.filter(F.col("doc_id").isNotNull())
    measured = materialize(rows.withColumn("_null", F.lit(None)).select("doc_id", "text").mapInArrow(_measured, "doc_id bigint, n bigint, s1 bigint, s2 bigint, sketch binary, token bigint, sets bigint"), "sets")
    sizes = measured.filter("n IS NOT NULL")
    top = measured.filter("token IS NOT NULL").groupBy("token").agg(F.sum("sets").alias("sets")).filter(F.col("sets") >= TOTAL)
    top = top.orderBy(F.desc("sets"), "token").limit(MOST_FREQUENT).collect()  # a bounded list; it only orders segments
    token = np.array([r.token for r in top], np.int64).view(np.uint64)
    level = np.array([int(r.sets).bit_length() for r in top], np.int64)
    order = np.argsort(token)
    total = sizes.agg(F.sum("n").alias("n")).first()["n"] or 0
    width = max(shuffle_width(spark), int(total * 0.4) // SIGNATURES_IN_TASK + 1)
    blobs = known.mapInArrow(_indexed(token[order], level[order], 8 * width), "bucket int, sigs binary, hubs binary, ids binary, kinds binary, hub_kinds binary")
    groups = materialize(blobs.repartition(width, "bucket").mapInArrow(_grouped, "sig bigint, hub bigint, id bigint, hub_kind bigint, kind bigint"), "groups")

    # exact copies: each to the smallest id of its set; rows of one id share it already
    copies = sizes.filter("n > 0 AND doc_id IS NOT NULL").select("doc_id", "s1", "s2")
    smallest = materialize(copies.groupBy("s1", "s2").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).filter("a < z").drop("z"), "smallest")
    links = materialize(copies.join(smallest.hint("merge"), ["s1", "s2"]).select("a", F.col("doc_id").alias("b")).filter("a <> b").distinct(), "copies")

    sketches = sizes.filter("n > 0 AND doc_id IS NOT NULL").select("doc_id", "n", "sketch")
    stars = groups.filter(_sizes_allow(groups["hub_kind"], groups["kind"])).select(F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b")).distinct()
    near = materialize(_sieved(_apart(stars, components(links)), sketches), "near")

    # each id with the smallest of its partners, then with its others that are not connected to it yet
    best = materialize(near.groupBy("b").agg(F.min("a").alias("a")), "best")
    links = links.union(_verified(best, _texts(known, _of_pairs(best))))
    comps = components(links)
    rest = materialize(_apart(near.join(best.hint("merge"), ["a", "b"], "left_anti"), comps), "rest")
    links = links.union(_verified(rest, _texts(known, _of_pairs(rest))))
    comps = components(links)
    links = links.union(_met_in_groups(groups, comps, known, sketches))
    comps = components(links)
    return sizes.join(comps, sizes["doc_id"] == comps["id"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("comp", "doc_id").alias("component_id")
    )


def _texts(known: DataFrame, ids: DataFrame) -> DataFrame:
    """Texts of the documents in ``ids``, which are broadcast up to MAX_BROADCAST_IDS of them."""
    ids = materialize(ids.distinct(), "ids")
    few = ids.count() <= MAX_BROADCAST_IDS
    texts = materialize(known.join(F.broadcast(ids) if few else ids.hint("merge"), "doc_id", "left_semi").distinct(), "texts")
    discard(ids)
    return texts


def _of_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))


def forest(sets: list[np.ndarray], comps: list[int], blocks: list[int]) -> list[tuple[int, int]]:
    """Linked pairs of positions that connect different components, as few as connect all that links do.

    With several blocks only pairs of two blocks are compared.  Common shingles of many sets are
    counted by a matrix product, those of few sets along their postings.
    """
    n, size = len(sets), np.array([len(s) for s in sets])
    label, block = np.unique(comps, return_inverse=True)[1], np.asarray(blocks)
    own = np.repeat(np.arange(n), size)
    _, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = count > max(8, n // 16)
    column = np.cumsum(common) - 1
    many = common[at]
    dense = np.zeros((n, int(common.sum())), np.float32)
    dense[own[many], column[at[many]]] = 1
    few = ~many & (count[at] > 1)
    own, at = own[few], at[few]
    by_token = np.argsort(at, kind="stable")
    holders, token = own[by_token], at[by_token]
    start, end = np.searchsorted(token, at, "left"), np.searchsorted(token, at, "right")
    apart = len(np.unique(block)) > 1
    out = []
    for lo in range(0, n, COMPARED):
        hi = min(n, lo + COMPARED)
        entry = slice(*np.searchsorted(own, [lo, hi]))
        k = end[entry] - start[entry]
        partner = holders[np.repeat(start[entry] - np.cumsum(k) + k, k) + np.arange(k.sum())]
        both = np.bincount(np.repeat(own[entry] - lo, k) * n + partner, minlength=(hi - lo) * n).reshape(-1, n) + dense[lo:hi] @ dense.T
        hit = ((DEN + NUM) * both >= NUM * (size[lo:hi, None] + size)) & (label[lo:hi, None] != label) & (np.arange(lo, hi)[:, None] < np.arange(n))
        if apart:
            hit &= block[lo:hi, None] != block
        for r, c in zip(*(x.tolist() for x in np.nonzero(hit)), strict=True):
            if label[lo + r] != label[c]:
                out.append((lo + r, c))
                label[label == label[c]] = label[lo + r]
    return out


@in_stage("jaccard")
def _tile_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (hub, lo, hi): the links of each tile that connect components."""

    def flush() -> Iterator[pa.RecordBatch]:
        if rows:
            ids, comps, blocks, sets = zip(*rows, strict=True)
            got = [sorted((ids[x], ids[y])) for x, y in forest(list(sets), list(comps), list(blocks))]
            yield pa.record_batch([pa.array([g[i] for g in got], pa.int64()) for i in (0, 1)], ["a", "b"])

    key, rows = None, []
    for b in batches:
        for *k, block, i, comp, s in zip(*(b.column(c).to_pylist() for c in ("hub", "lo", "hi", "block", "id", "comp", "tokens")), strict=True):
            if k != key:
                yield from flush()
                key, rows = k, []
            rows.append((i, comp, block, np.frombuffer(s, np.uint64)))
    yield from flush()


@in_stage("jaccard")
def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = [shingles(t) for t in b.column("text").to_pylist()]
        size = pa.array([len(x) for x in sets], pa.int64())
        yield pa.record_batch([b.column("doc_id"), size, pa.array([x.tobytes() for x in sets], pa.binary())], ["doc_id", "size", "tokens"])


def partners(n: np.ndarray, comps: np.ndarray, blocks: np.ndarray, sketches: list[bytes]) -> np.ndarray:
    """Which members have one of another component that their sketches and sizes do not rule out.

    With several blocks only pairs of two blocks are compared.  Members whose sketches have the same length are
    compared word by word; two that link differ in size by a third at most, so lengths by a factor of two, for
    which the longer sketch is folded.
    """
    out = np.zeros(len(n), bool)
    apart = len(np.unique(blocks)) > 1
    words = np.array([len(s) // 8 for s in sketches])
    of = {}
    for w in np.unique(words).tolist():
        rows = np.flatnonzero(words == w)
        rows = rows[np.argsort(n[rows], kind="stable")]
        of[w] = rows, np.frombuffer(b"".join(sketches[r] for r in rows.tolist()), np.uint64).reshape(len(rows), w)
    names, count = np.unique(comps, return_counts=True)
    other = comps != names[count.argmax()]  # of two members of the commonest component none needs comparing

    def compare(left: np.ndarray, a: np.ndarray, right: np.ndarray, b: np.ndarray) -> None:
        step = max(1, SIEVED_AT_ONCE // max(1, b.size))
        for lo in range(0, len(left), step):
            mine = left[lo : lo + step]
            near = slice(*np.searchsorted(n[right], [-(-n[mine[0]] * NUM // DEN), n[mine[-1]] * DEN // NUM + 1]))
            theirs = right[near]
            if not len(theirs):
                continue
            hit = comps[mine][:, None] != comps[theirs]
            if apart:
                hit &= blocks[mine][:, None] != blocks[theirs]
            hit &= (n[mine][:, None] * DEN >= n[theirs] * NUM) & (n[theirs] * DEN >= n[mine][:, None] * NUM)
            if not hit.any():
                continue
            differ = np.bitwise_count(a[lo : lo + step, None, :] ^ b[None, near, :]).sum(2, dtype=np.int64)
            hit &= differ <= (n[mine][:, None] + n[theirs]) * (DEN - NUM) // (DEN + NUM)
            out[mine[hit.any(1)]] = True
            out[theirs[hit.any(0)]] = True

    for w, (rows, marks) in of.items():
        few = other[rows]
        compare(rows[few], marks[few], rows, marks)
        if 2 * w in of:
            longer, more = of[2 * w]
            folded, some = more[:, :w] ^ more[:, w:], other[longer]
            compare(rows[few], marks[few], longer, folded)
            compare(rows[~few], marks[~few], longer[some], folded[some])
    return out


@in_stage("jaccard")
def _tile_partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (hub, lo, hi): (hub, id) of the members of each tile that ``partners`` leaves."""

    def flush() -> Iterator[pa.RecordBatch]:
        if len(rows) > 1:
            block, ids, comp, n, sketches = zip(*rows, strict=True)
            stay = np.flatnonzero(partners(np.array(n), np.array(comp), np.array(block), list(sketches)))
            if len(stay):
                yield pa.record_batch([pa.array([key[0]] * len(stay), pa.int64()), pa.array(np.array(ids, np.int64)[stay])], ["hub", "id"])

    key, rows = None, []
    for b in batches:
        for *k, block, i, comp, n, s in zip(*(b.column(c).to_pylist() for c in ("hub", "lo", "hi", "block", "id", "comp", "n", "sketch")), strict=True):
            if k != key:
                yield from flush()
                key, rows = k, []
            rows.append((block, i, comp, n, s))
    yield from flush()


def _dealt(members: DataFrame, weighed: DataFrame, most: int) -> DataFrame:
    """``members`` (hub, id, ...) once for every tile (hub, lo, hi) they are in: a group is dealt into blocks of
    about ``most`` by the weights in ``weighed`` (hub, weight), a tile is two blocks or one."""
    blocks = weighed.groupBy("hub").agg(F.ceil(F.sum("weight") / F.lit(most)).alias("blocks"))
    dealt = members.join(blocks.hint("merge"), "hub").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    return dealt.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")}).drop("other", "blocks")


def _met_in_groups(groups: DataFrame, comps: DataFrame, known: DataFrame, sketches: DataFrame) -> DataFrame:
    """Links (a, b) between members of one group in different components.

    Members of groups with one head are compared together, each once for all signatures they share.  First
    by sizes and sketches, a few words each; only members that have a possible partner left send their
    shingles.  Both times groups are dealt into blocks of bounded weight; a task holds two blocks at most and
    sends on no more links than connect its members, so nothing grows with the pairs of a group but the
    comparisons themselves.
    """
    width = shuffle_width(groups.sparkSession)
    comp = comps.select(F.col("id").alias("_id"), "comp")
    rows = groups.select("sig", "hub", "id")
    # a group that one batch holds in part has a head of its own there; the smallest stands for the signature
    heads = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("_rows"), F.min("hub").alias("head")).filter("_rows > 1").drop("_rows")
    all_of = rows.select("sig", "id").union(rows.select("sig", F.col("hub").alias("id"))).join(heads.hint("merge"), "sig")
    labelled = materialize(all_of.join(comp, all_of["id"] == comp["_id"], "left").select("sig", "head", "id", F.coalesce("comp", "id").alias("comp")), "members")
    open_groups = labelled.groupBy("sig").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high").select("sig")
    members = materialize(labelled.join(open_groups.hint("merge"), "sig", "left_semi").select(F.col("head").alias("hub"), "id", "comp").distinct(), "open-members")
    discard(labelled)

    marked = members.join(sketches.withColumnRenamed("doc_id", "id").hint("merge"), "id")
    weighed = marked.select("hub", (F.octet_length("sketch") / 8 + 4).alias("weight"))
    tiles = _dealt(marked, weighed, SIEVED).repartition(width, "hub", "lo", "hi").sortWithinPartitions("hub", "lo", "hi", "id")
    left = materialize(tiles.mapInArrow(_tile_partners, "hub bigint, id bigint").distinct(), "partners")
    members = materialize(members.join(left.hint("merge"), ["hub", "id"], "left_semi"), "compared")

    texts = _texts(known, members.select(F.col("id").alias("doc_id")))
    sets = materialize(texts.mapInArrow(_sets, "doc_id bigint, size bigint, tokens binary"), "open-sets").withColumnRenamed("doc_id", "id")
    discard(texts)
    weighed = members.join(sets.select("id", "size").hint("merge"), "id").select("hub", (F.col("size") + SMALL).alias("weight"))
    tiles = _dealt(members, weighed, TILE).join(sets.select("id", "tokens").hint("merge"), "id").repartition(width, "hub", "lo", "hi")
    return materialize(tiles.sortWithinPartitions("hub", "lo", "hi", "id").mapInArrow(_tile_links, "a bigint, b bigint").distinct(), "met")
