"""Phrase collocation mining with counting quotient filters.

Words get ids (the rank of their 64-bit hash among the frequent words), and an n-gram's ids are packed
into one or more 64-bit lanes.  An invertible permutation spreads the first lane; its high bits are the
quotient (bucket and slot, kept as a bit vector of run lengths), its low bits and the other lanes the full
remainder, so a filter's counters are lossless.  Each task fills filters of bounded size and writes them
as sorted blocks per bucket; blocks of one bucket meet in one task, where the sorted filters are merged by
adding equal entries.  The permutation spreads any skew: a phrase however frequent is one entry a filter,
and a bucket holds about ``MERGE_ENTRIES`` entries at any input size.

Levels: an n-gram can be frequent only if both (n-1)-grams in it are, so level n looks at the positions
that two bits of the (n-1)-gram bitmap allow.  A bitmap has at most ``MOST_BITS`` bits; a full one lets
more n-grams be counted, never fewer.  All that scores need (both parts of every cut) is then frequent
as well, so nothing below the threshold leaves the tasks.  The frequent words' hashes are broadcast only
up to ``MAX_WORDS`` (counted first); beyond that the hashes themselves are the ids, in more lanes.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairforge.llm.common import materialize, stage_begins

LONGEST, MIN_COUNT, COVERED, SCALE, TOP = 4, 30, (80, 100), 2_000_000, 2000
WINDOW, MAX_WORDS, FILTER_ENTRIES, MERGE_ENTRIES, MOST_BITS, DISTINCT = 1 << 21, 1 << 21, 1 << 21, 1 << 21, 27, 300_000
#: A-Z become a-z, separators of pieces a full stop, tabs spaces.
FOLD = bytes(c + 32 if 65 <= c <= 90 else 46 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256))
_A, _B = 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD  # odd, so multiplying by them is invertible


def _xor_shift(x: np.ndarray, by: int) -> np.ndarray:
    return x ^ (x >> np.uint64(by))


def spread(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers whose high bits depend on all bits."""
    x = _xor_shift(x, 32) * np.uint64(_A)
    return _xor_shift(_xor_shift(x, 32) * np.uint64(_B), 32)


def unspread(x: np.ndarray) -> np.ndarray:
    """The inverse of ``spread`` (shifts by half the width undo themselves)."""
    x = _xor_shift(_xor_shift(x, 32) * np.uint64(pow(_B, -1, 1 << 64)), 32)
    return _xor_shift(x * np.uint64(pow(_A, -1, 1 << 64)), 32)


def _mask(lanes: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(lanes[0]), np.uint64)
    for x in lanes[1:]:
        out = spread(out + x + np.uint64(_A))
    return out


def permute(lanes: list[np.ndarray]) -> list[np.ndarray]:
    """The first lane is spread over 64 bits after a mask of the other lanes; invertible as a whole."""
    return [spread(lanes[0] ^ _mask(lanes) if len(lanes) > 1 else lanes[0]), *lanes[1:]]


def unpermute(lanes: list[np.ndarray]) -> list[np.ndarray]:
    first = unspread(lanes[0])
    return [first ^ _mask(lanes) if len(lanes) > 1 else first, *lanes[1:]]


def pack(ids: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """Ids of ``bits`` bits, as many to a lane as fit."""
    per, lanes = 64 // bits, []
    for at in range(0, len(ids), per):
        lane = ids[at].astype(np.uint64)
        for j, x in enumerate(ids[at + 1 : at + per], 1):
            lane = lane | (x.astype(np.uint64) << np.uint64(bits * j))
        lanes.append(lane)
    return lanes


def unpack(lanes: list[np.ndarray], bits: int, n: int) -> list[np.ndarray]:
    per, low = 64 // bits, np.uint64((1 << bits) - 1)
    return [(lanes[i // per] >> np.uint64(bits * (i % per))) & low for i in range(n)]


def combine(parts: list[tuple[list[np.ndarray], np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted union of (lanes, counts) parts, the counts of equal entries added."""
    lanes = [np.concatenate(x) for x in zip(*(p[0] for p in parts), strict=True)]
    counts = np.concatenate([p[1] for p in parts])
    if not len(counts):
        return lanes, counts
    order = np.argsort(lanes[0], kind="stable")
    if len(lanes) > 1:
        near = lanes[0][order]
        tied = near[1:] == near[:-1]
        if any((x[order][1:] != x[order][:-1])[tied].any() for x in lanes[1:]):
            order = np.lexsort(lanes[::-1])
    lanes = [x[order] for x in lanes]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in lanes])
    at = np.flatnonzero(new)
    return [x[at] for x in lanes], np.add.reduceat(counts[order], at)


class QuotientFilter:
    """Sorted entries of one bucket as bytes: a bit vector of the slots' run lengths, remainders without
    the quotient's bits, further lanes whole, counters of one byte with the larger ones listed."""

    @staticmethod
    def dump(lanes: list[np.ndarray], counts: np.ndarray, bucket_bits: int) -> bytes:
        n = len(counts)
        slot_bits = max(0, n.bit_length() - 1)
        left = 64 - bucket_bits - slot_bits
        inside = (lanes[0] << np.uint64(bucket_bits)) >> np.uint64(bucket_bits) if bucket_bits else lanes[0]
        slot = (inside >> np.uint64(left)).astype(np.int64) if slot_bits else np.zeros(n, np.int64)
        marks = np.zeros(n + (1 << slot_bits), np.uint8)
        marks[slot + np.arange(n)] = 1
        width = -(-left // 8)
        rest = (inside & np.uint64((1 << left) - 1)).astype("<u8").view(np.uint8).reshape(n, 8)[:, :width]
        large = np.flatnonzero(counts >= 255)
        head = np.array([n, slot_bits, bucket_bits, len(lanes), len(large)], "<i8")
        return b"".join([head.tobytes(), np.packbits(marks).tobytes(), rest.tobytes(), *(x.astype("<u8").tobytes() for x in lanes[1:]), np.minimum(counts, 255).astype(np.uint8).tobytes(), large.astype("<i8").tobytes(), counts[large].astype("<i8").tobytes()])

    @staticmethod
    def load(data: bytes, bucket: int) -> tuple[list[np.ndarray], np.ndarray]:
        n, slot_bits, bucket_bits, n_lanes, n_large = (int(x) for x in np.frombuffer(data, "<i8", 5))
        left, at = 64 - bucket_bits - slot_bits, 40
        size = n + (1 << slot_bits)
        marks = np.unpackbits(np.frombuffer(data, np.uint8, -(-size // 8), at), count=size)
        at += -(-size // 8)
        slot = (np.flatnonzero(marks) - np.arange(n)).astype(np.uint64)
        width = -(-left // 8)
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
        at += n * width
        first = wide.reshape(-1).view("<u8").astype(np.uint64)
        if slot_bits:
            first |= slot << np.uint64(left)
        if bucket_bits:
            first |= np.uint64(bucket) << np.uint64(64 - bucket_bits)
        lanes = [first]
        for _ in range(n_lanes - 1):
            lanes.append(np.frombuffer(data, "<u8", n, at).astype(np.uint64))
            at += 8 * n
        counts = np.frombuffer(data, np.uint8, n, at).astype(np.int64)
        at += n
        large = np.frombuffer(data, "<i8", n_large, at)
        counts[large] = np.frombuffer(data, "<i8", n_large, at + 8 * n_large)
        return lanes, counts


def _some(batch: pa.RecordBatch, size: int) -> Iterator[tuple[str, list[bytes]]]:
    """The batch's texts by language, in lists of about ``size`` bytes."""
    langs, texts = batch.column("lang"), batch.column("text")
    for lang in pc.unique(langs).to_pylist():
        some, held = [], 0
        for i in pc.indices_nonzero(pc.equal(langs, lang)).to_pylist():
            some.append(texts[i].as_py())
            held += len(some[-1])
            if held >= size:
                yield lang, some
                some, held = [], 0
        if some:
            yield lang, some


def _windows(batch: pa.RecordBatch, window: int) -> Iterator[tuple[str, pa.Array, np.ndarray, bool]]:
    """(lang, distinct words, one index a word, whether texts begin) of runs of about ``window`` bytes; -1
    stands between pieces and texts; a run that begins no texts goes on with the run before it."""
    for lang, texts in _some(batch, 2 * window):
        data = b".".join(texts).translate(FOLD).replace(b".", b" . ")
        at = 0
        while at < len(data):
            cut, begins = len(data), at == 0
            if at + window < cut:
                cut = data.rfind(b" ", at + 1, at + window)
                cut = cut if cut > 0 else data.find(b" ", at + window)
                cut = cut if cut > 0 else len(data)
            split = pc.split_pattern(pa.array([data[at:cut]], pa.large_binary()), " ").flatten()
            at = cut
            coded = split.dictionary_encode()
            words, index = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            blank, stop = pc.index(words, pa.scalar(b"", words.type)).as_py(), pc.index(words, pa.scalar(b".", words.type)).as_py()
            if blank >= 0:
                index = index[index != blank]
            if stop >= 0:
                index = np.where(index == stop, -1, index)
            yield lang, words, index, begins


def _hash(lang: str, word: bytes, seed: int) -> int:
    return xxhash.xxh64_intdigest(lang.encode() + b"\0" + word, seed)


def _count_words(seed: int, window: int):
    schema = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("hash", pa.int64()), ("f", pa.int64())])

    def out(held: dict[str, Counter]) -> pa.RecordBatch:
        rows = [(lang, w, _hash(lang, w, seed), n) for lang, c in held.items() for w, n in c.items()]
        h = np.array([r[2] for r in rows], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary()), pa.array(h), pa.array([r[3] for r in rows], pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stage_begins("collocations")
        held: dict[str, Counter] = {}
        for b in batches:
            for lang, words, index, _ in _windows(b, window):
                n = np.bincount(index[index >= 0], minlength=len(words))
                c = held.setdefault(lang, Counter())
                for w, x in zip(words.to_pylist(), n.tolist(), strict=True):
                    if x:
                        c[w] += x
                if sum(map(len, held.values())) > DISTINCT:
                    yield out(held)
                    held = {}
        yield out(held)

    return run


def _encode_ids(known: np.ndarray | None, bitmap: np.ndarray | None, seed: int, window: int):
    """Rows of zstd-compressed ids (0: a boundary or an infrequent word); a run starts with the last
    LONGEST - 1 ids of the run before it, and ``lead`` tells how many these are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stage_begins("collocations")
        press = zstandard.ZstdCompressor(level=1)
        for b in batches:
            tail = np.zeros(0, np.uint64)
            for lang, words, index, begins in _windows(b, window):
                h = np.fromiter((_hash(lang, w, seed) for w in words.to_pylist()), np.uint64, len(words))
                if known is None:
                    ids = np.where(_hit(bitmap, spread(h)), h, np.uint64(0))
                elif len(known):
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    ids = np.where(known[at] == h, at + 1, 0).astype(np.uint64)
                else:
                    ids = np.zeros(len(h), np.uint64)
                ids = np.append(ids, np.uint64(0))[index]  # -1 takes the last
                if begins:
                    tail = tail[:0]
                whole = np.concatenate([tail, ids])
                lead, tail = len(tail), whole[-(LONGEST - 1) :]
                raw = whole.astype("<u4" if known is not None else "<u8").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([lead], pa.int32()), pa.array([press.compress(raw)], pa.binary())], names=["lead", "ids"])

    return run


def _hit(bitmap: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether the bit of each permuted first lane is set; the bitmap has a power of two of bits."""
    at = first >> np.uint64(64 - (len(bitmap).bit_length() + 5))
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _fill_filters(n: int, bits: int, wide: bool, bitmap: np.ndarray | None, bucket_bits: int, most: int):
    """Level ``n``: filters of the n-grams in the id runs, as (bucket, block) rows."""

    def blocks(lanes: list[np.ndarray], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        edges = np.searchsorted(lanes[0] >> np.uint64(64 - bucket_bits), np.arange((1 << bucket_bits) + 1, dtype=np.uint64))
        full = np.flatnonzero(np.diff(edges))
        for at in range(0, len(full), 64):
            some = full[at : at + 64]
            data = [QuotientFilter.dump([x[edges[i] : edges[i + 1]] for x in lanes], counts[edges[i] : edges[i + 1]], bucket_bits) for i in some]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(data, pa.binary())], names=["bucket", "block"])

    def grams(lead: int, data: bytes) -> list[np.ndarray]:
        a = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<u8" if wide else "<u4").astype(np.uint64)[max(0, lead - n + 1) :]
        size = len(a) - n + 1
        if size <= 0:
            return pack([a[:0]] * n, bits)
        ok = a != 0
        valid = np.logical_and.reduce([ok[j : j + size] for j in range(n)])
        at = np.flatnonzero(valid)
        if bitmap is not None:
            for shift in (0, 1):
                at = at[_hit(bitmap, permute(pack([a[at + shift + j] for j in range(n - 1)], bits))[0])]
        return permute(pack([a[at + j] for j in range(n)], bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stage_begins("collocations")
        parts, held = [], 0
        for b in batches:
            for lead, data in zip(b.column("lead").to_pylist(), b.column("ids").to_pylist(), strict=True):
                lanes = grams(lead, data)
                if not len(lanes[0]):
                    continue
                parts.append(combine([(lanes, np.ones(len(lanes[0]), np.int64))]))
                held += len(parts[-1][1])
                if held > most:
                    parts = [combine(parts)]
                    held = len(parts[0][1])
                    if held > most // 2:
                        yield from blocks(*parts[0])
                        parts, held = [], 0
        if parts:
            yield from blocks(*combine(parts))

    return run


def _merge_filters(n: int, bits: int, known: np.ndarray | None, min_count: int, most: int):
    """Blocks sorted by bucket: the merged filter's entries of at least ``min_count``, as word hashes."""

    def out(parts: list) -> Iterator[pa.RecordBatch]:
        lanes, counts = combine(parts)
        keep = counts >= min_count
        lanes, counts = [x[keep] for x in lanes], counts[keep]
        ids = unpack(unpermute(lanes), bits, n)
        hashes = np.stack([x if known is None else known[(x - np.uint64(1)).astype(np.int64)] for x in ids], 1).view(np.int64)
        for at in range(0, len(counts), 100_000):
            some = hashes[at : at + 100_000]
            gram = pa.ListArray.from_arrays(pa.array(np.arange(0, some.size + 1, n), pa.int32()), pa.array(some.reshape(-1)))
            yield pa.RecordBatch.from_arrays([gram, pa.array(lanes[0][at : at + 100_000].view(np.int64)), pa.array(counts[at : at + 100_000])], names=["gram", "first", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stage_begins("collocations")
        now, parts, held = None, [], 0
        for b in batches:
            for bucket, data in zip(b.column("bucket").to_pylist(), b.column("block").to_pylist(), strict=True):
                if bucket != now and parts:
                    yield from out(parts)
                    parts, held = [], 0
                now = bucket
                parts.append(QuotientFilter.load(data, bucket))
                held += len(parts[-1][1])
                if held > most and len(parts) > 1:
                    parts = [combine(parts)]
                    held = 0
        if parts:
            yield from out(parts)

    return run


def _bitmap(firsts: DataFrame, rows: int, most_bits: int) -> np.ndarray:
    """Bits of the permuted first lanes, about 32 an entry but at most 2 ** ``most_bits`` in all."""
    bits = min(most_bits, max(6, math.ceil(math.log2(32 * max(rows, 1)))))
    at = F.shiftrightunsigned("first", 64 - bits)
    words = firsts.groupBy(F.shiftrightunsigned(at, 6).alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(first, {64 - bits}) & 63 as int))")).alias("m"))
    out = np.zeros(1 << (bits - 6), np.uint64)
    got = words.toArrow()
    out[got.column("w").to_numpy()] = got.column("m").to_numpy().view(np.uint64)
    return out


def frequent_phrases(docs: DataFrame, *, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, window: int = WINDOW, filter_entries: int = FILTER_ENTRIES, merge_entries: int = MERGE_ENTRIES, most_bits: int = MOST_BITS) -> tuple[DataFrame, DataFrame]:
    """(lang, n: all word occurrences), (lang, phrase, k, f) of every phrase of 1 to 4 words with
    f >= ``min_count``; all counts are exact.  ``docs`` has lang and text."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    for seed in range(8):
        counted = texts.mapInArrow(_count_words(seed, window), "lang string, word binary, hash bigint, f bigint")
        words = materialize(counted.groupBy("lang", "word", "hash").agg(F.sum("f").alias("f")), "colloc-words")
        clash = words.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.max("f").alias("f")).filter((F.col("n") > 1) & (F.col("f") >= min_count))
        if clash.isEmpty():
            break
    else:
        raise RuntimeError("frequent words share 64-bit hashes under every seed")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = words.filter(F.col("f") >= min_count)
    size, occurrences = frequent.count(), words.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
    known = np.sort(frequent.select("hash").toArrow().column("hash").to_numpy().view(np.uint64)) if size <= max_words else None
    bits = 64 if known is None else max(1, size.bit_length())
    bucket_bits = max(4, math.ceil(math.log2(max(1, occurrences) / merge_entries)))
    spread_hash = None
    if known is None:
        spread_hash = _bitmap(frequent.mapInArrow(_spread_hashes, "first bigint"), size, most_bits)
    ids = materialize(texts.mapInArrow(_encode_ids(known, spread_hash, seed, window), "lead int, ids binary"), "colloc-ids")
    grams, bitmap = [], None
    for n in range(2, LONGEST + 1):
        filled = ids.mapInArrow(_fill_filters(n, bits, known is None, bitmap, bucket_bits, filter_entries), "bucket bigint, block binary")
        merged = filled.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_merge_filters(n, bits, known, min_count, merge_entries), "gram array<bigint>, first bigint, f bigint")
        level = materialize(merged, f"colloc-{n}")
        grams.append(level.select("gram", "f"))
        if n < LONGEST:
            bitmap = _bitmap(level.select("first"), level.count(), most_bits)
    every = grams[0].unionByName(grams[1]).unionByName(grams[2])
    spelled = every.select("gram", "f", F.posexplode("gram").alias("i", "hash")).join(frequent.select("lang", F.col("word").cast("string").alias("word"), "hash"), "hash")
    phrases = spelled.groupBy("gram", "f", "lang").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    counts = phrases.select("lang", "phrase", F.size("gram").alias("k"), "f").unionByName(frequent.select("lang", F.col("word").cast("string").alias("phrase"), F.lit(1).alias("k"), "f"))
    return totals, materialize(counts, "colloc-counts")


def _spread_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array(spread(b.column("hash").to_numpy().view(np.uint64)).view(np.int64))], names=["first"])


def _wide(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")


def collocations(docs: DataFrame, *, top: int = TOP, **bounds: int) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of 2 to 4 words.

    Texts are lower-cased in A-Z, cut into pieces at ``.,;:!?`` and line ends and into words at spaces
    and tabs.  f counts all occurrences within pieces, n all words of the language.  A phrase with
    a = f >= 30 scores floor(2000000 a / (l + r)) at its lowest-scoring cut, ties to the shortest first
    part; it goes if a longer one that holds it has 100 f >= 80 a.  Order: score and a descending,
    phrase ascending by bytes.  A null lang is ``und``, a null text is empty; repeated rows count each;
    no words, no rows.  Other columns are ignored.  Arithmetic is decimal, so products never overflow.
    """
    totals, counts = frequent_phrases(docs, **bounds)
    cand = counts.filter("k >= 2").withColumn("w", F.split("phrase", " ")).withColumnRenamed("f", "a")
    part = lambda first, size: F.array_join(F.slice("w", first, size), " ")
    cuts = cand.withColumn("c", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "c", part(F.lit(1), F.col("c")).alias("first"), part(F.col("c") + 1, F.col("k") - F.col("c")).alias("rest"))
    f = counts.select("lang", "phrase", "f")
    cuts = cuts.join(f.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(f.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    cuts = cuts.withColumns({"x": _wide("a") * F.lit(SCALE).cast("decimal(10,0)"), "y": _wide("l") + _wide("r")}).withColumn("score", F.expr("cast(x as decimal(38,0)) div cast(y as decimal(38,0))"))
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "c", "l", "r")).alias("b"))
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("k") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("k") - m + 1), lambda i: F.array_join(F.slice("w", i, m), " "))))
    inner = cand.filter("k >= 3").select("lang", F.col("a").alias("longer"), F.explode(F.array_distinct(spans)).alias("phrase"))
    cover = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    share, of = COVERED
    gone = F.col("longer").isNotNull() & (_wide("longer") * F.lit(of).cast("decimal(5,0)") >= _wide("a") * F.lit(share).cast("decimal(5,0)"))
    kept = best.join(cover, ["lang", "phrase"], "left").filter(~gone)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.select("lang", "phrase", "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"), F.col("b.score").alias("score")).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
      FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, phrase, k, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 30),
x AS (SELECT lang, phrase, k, a, w, unnest(range(1, k)) AS j FROM c),
s AS (SELECT x.lang, x.phrase, x.a, x.j, l.f AS l, r.f AS r, CAST(2000000 * CAST(x.a AS HUGEINT) // (l.f + r.f) AS BIGINT) AS score
      FROM x JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(x.w[1:x.j], ' ')
             JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(x.w[x.j + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
i AS (SELECT lang, a, k, w, unnest(range(2, k)) AS m FROM c WHERE k > 2),
v AS (SELECT lang, a, unnest(list_transform(range(1, k - m + 2), lambda q: array_to_string(w[q:q + m - 1], ' '))) AS phrase FROM i),
o AS (SELECT lang, phrase, max(a) AS longer FROM v GROUP BY ALL),
z AS (SELECT b.lang, b.phrase, b.a, b.l, b.r, b.score, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank
      FROM b LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase WHERE o.longer IS NULL OR 100 * CAST(o.longer AS HUGEINT) < 80 * CAST(b.a AS HUGEINT))
SELECT z.lang, z.rank, z.phrase, z.a, z.l, z.r, n.n, z.score FROM z JOIN n ON n.lang = z.lang WHERE z.rank <= 2000
"""
