"""BPE encoding and decoding with tree concatenation of long unsplit text.

A text over CUT bytes is cut into halves again and again, at any code point, and the halves are put
together as a tree.  A join that falls between two characters of a word re-encodes a window around
it (the runs between white space that it broke, and as many whole runs on either side, twice as many
each time) until the tokens of the whole runs at both edges are the ones that both sides had.
White space of ASCII never lies inside a pre-token and no normalisation reaches across it, so the
runs between it are encoded on their own (each distinct one once, in a bounded table of two
generations per worker).  Within a run, a pre-token longer than LEAF symbols is unsplit text: its halves are encoded apart, and at each
join a window of tokens around the join is re-encoded, twice as wide each time, until the pair of
tokens at either edge of the window is one that BPE itself leaves unmerged; all of the encoding is
then the one BPE makes of the whole.

Scale: documents up to SPLIT_CHARS are one map.  Longer ones are cut into pieces (at white space;
unsplit runs into halves of their pre-tokens), the pieces are dealt over the cluster and encoded
in parallel, and one task per long document joins them.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.llm import common
from pairforge.llm.common import in_stage, shuffle_width

#: Symbols of a pre-token that are encoded in one go; code points of a document that is one row.
LEAF, SPLIT_CHARS = 512, 65_536
#: Bytes of a text, or of a half of one, that is split into runs in one go.
CUT = 16_384
#: Runs longer than this many bytes don't enter the table of known runs; the entries of one of its two generations.
LONG_RUN, KNOWN_RUNS = 256, 100_000
SUFFIX = "</w>"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Bpe:
    """One tokenizer file: library encoding of short runs, tree concatenation of long pre-tokens."""

    def __init__(self, path: str, leaf: int = LEAF, cut: int = CUT) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        spec = json.load(open(path, encoding="utf-8"))
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ", 1)) for m in spec["model"]["merges"]]
        vocab = spec["model"]["vocab"]
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        self.inner = BPE(vocab=vocab, merges=merges)  # the same merges where no symbol ends a word
        self.last = BPE(vocab=vocab, merges=merges, end_of_word_suffix=self.suffix) if self.suffix else self.inner
        self.leaf, self.cut, self.joins = leaf, max(cut, 8), 0
        size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.token = [self.whole.id_to_token(i) or "" for i in range(size)]
        self.id_bytes = [str(i).encode() for i in range(size)]
        self.token_bytes = [t.encode() for t in self.token]
        special = [re.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = re.compile("|".join(sorted(special, key=len, reverse=True))) if special else None
        self.known: dict[bytes, tuple[bytes, int, bytes]] = {}
        self.older: dict[bytes, tuple[bytes, int, bytes]] = {}

    # -- long pre-tokens -------------------------------------------------------------------------

    def symbols_ids(self, symbols: str, final: bool) -> list[int]:
        return [t.id for t in (self.last if final else self.inner).tokenize(symbols)] if symbols else []

    def _symbols(self, ids: list[int], final: bool) -> str:
        s = "".join(self.token[i] for i in ids)
        return s[: -len(self.suffix)] if final and self.suffix and ids else s

    def _unmerged(self, a: int, b: int, final: bool) -> bool:
        return self.symbols_ids(self._symbols([a, b], final), final) == [a, b]

    def join(self, left: list[int], right: list[int], final: bool) -> list[int]:
        """Encoding of the concatenation of two encoded texts; ``final``: the right one ends its pre-token."""
        if not left or not right:
            return left + right
        k = 1
        while True:
            a, b = max(0, len(left) - k), min(len(right), k)
            ends = final and b == len(right)
            window = self.symbols_ids(self._symbols(left[a:] + right[:b], ends), ends)
            agree_left = a == 0 or self._unmerged(left[a - 1], window[0], ends and len(window) == 1)
            agree_right = b == len(right) or self._unmerged(window[-1], right[b], final and b + 1 == len(right))
            if agree_left and agree_right:
                return left[:a] + window + right[b:]
            k *= 2

    def concat(self, leaves: list[list[int]]) -> list[int]:
        """Joins encoded leaves of one pre-token as a tree."""
        level = [(x, i == len(leaves) - 1) for i, x in enumerate(leaves)]
        while len(level) > 1:
            pairs = [level[i : i + 2] for i in range(0, len(level), 2)]
            level = [(self.join(p[0][0], p[1][0], p[1][1]), p[1][1]) if len(p) == 2 else p[0] for p in pairs]
        return level[0][0] if level else []

    def halves(self, symbols: str) -> list[str]:
        if len(symbols) <= self.leaf:
            return [symbols]
        mid = len(symbols) // 2
        return self.halves(symbols[:mid]) + self.halves(symbols[mid:])

    def pretokens(self, run: str) -> list[tuple[str, int]]:
        """(symbols, special id or -1) of a run without ASCII white space."""
        out, at = [], 0
        for m in [*(self.special.finditer(run) if self.special else ()), None]:
            plain = run[at : m.start() if m else len(run)]
            if plain:
                normal = self.whole.normalizer.normalize_str(plain) if self.whole.normalizer else plain
                out += [(s, -1) for s, _ in self.whole.pre_tokenizer.pre_tokenize_str(normal)]
            if m:
                out.append(("", self.whole.token_to_id(m.group())))
                at = m.end()
        return out

    def long_run(self, run: str) -> list[int]:
        ids: list[int] = []
        for symbols, special in self.pretokens(run):
            if special >= 0:
                ids.append(special)
            else:
                parts = self.halves(symbols)
                ids += self.concat([self.symbols_ids(p, i == len(parts) - 1) for i, p in enumerate(parts)])
        return ids

    # -- texts -----------------------------------------------------------------------------------

    def entry(self, ids: list[int]) -> tuple[bytes, int, bytes]:
        return b" ".join([self.id_bytes[i] for i in ids]), len(ids), b" ".join([self.token_bytes[i] for i in ids])

    def _ids(self, runs: list[bytes]) -> list[int]:
        return self.whole.encode(b" ".join(runs).decode(), add_special_tokens=False).ids

    def joined(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        """The runs of a text from the runs of its halves, of which the last and the first are parts of one."""
        self.joins += 1
        mended, k = left[-1] + right[0], 1
        while True:
            before, after = left[:-1][-k:], right[1 : k + 1]
            got, head, tail = self._ids([*before, mended, *after]), self._ids(before), self._ids(after)
            if got[: len(head)] == head and got[len(got) - len(tail) :] == tail:
                return [*left[:-1], mended, *right[1:]]
            if len(before) < k and len(after) < k:
                raise ValueError("the tokenizer's tokens reach across white space")
            k *= 2

    def runs(self, text: bytes) -> list[bytes]:
        """The runs of a text without ASCII white space, by halves that are cut anywhere."""
        if len(text) <= self.cut:
            return text.split()  # bytes split at exactly the ASCII white space
        mid = len(text) // 2
        while mid < len(text) and text[mid] & 0xC0 == 0x80:  # inside a code point
            mid += 1
        left, right = self.runs(text[:mid]), self.runs(text[mid:])
        broken = left and right and not text[mid - 1 : mid].isspace() and not text[mid : mid + 1].isspace()
        if not broken:
            return left + right
        if max(len(left[-1]), len(right[0])) > LONG_RUN:  # unsplit text: joined by its own tokens later on
            return [*left[:-1], left[-1] + right[0], *right[1:]]
        return self.joined(left, right)

    def encode(self, texts: list[bytes]) -> list[tuple[bytes, int, bytes]]:
        """(decimal ids joined by one space, their number, decoded text) of each text."""
        runs = [self.runs(t) for t in texts]
        if len(self.known) > KNOWN_RUNS:  # a run that is not met again during a whole generation goes
            self.older, self.known = self.known, {}
        known, older, new = self.known, self.older, []
        for w in {w for r in runs for w in r}:
            if w not in known:
                if w in older:
                    known[w] = older[w]
                else:
                    new.append(w)
        short = [w for w in new if len(w) <= LONG_RUN]
        for w, e in zip(short, self.whole.encode_batch_fast([w.decode() for w in short], add_special_tokens=False), strict=True):
            known[w] = self.entry(e.ids)
        long = {w: self.entry(self.long_run(w.decode())) for w in new if len(w) > LONG_RUN}
        known.update(long)
        out = []
        for r in runs:
            if not r:
                out.append((b"", 0, b""))
                continue
            ids, counts, decoded = zip(*map(known.__getitem__, r), strict=True)
            if 0 in counts:  # a run that the normaliser empties
                ids, decoded = [x for x, n in zip(ids, counts, strict=True) if n], [x for x, n in zip(decoded, counts, strict=True) if n]
            out.append((b" ".join(ids), sum(counts), b" ".join(decoded)))
        for w in long:
            del known[w]
        return out

    def encode_ids(self, text: str) -> list[int]:
        ids = self.encode([text.encode()])[0][0]
        return [int(x) for x in ids.split()]


@lru_cache(maxsize=4)
def tokenizer(path: str, leaf: int = LEAF) -> Bpe:
    """One per worker: the table of known runs serves all its tasks, until another operator's stage begins there."""
    return Bpe(path, leaf)


common.CACHES["bpe"] = tokenizer.cache_clear


def _some(sizes: Iterable[int], most: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts, of ``sizes`` bytes, hold about ``most`` bytes."""
    at, i, size = 0, 0, 0
    for i, n in enumerate(sizes, 1):
        size += n
        if size >= most:
            yield at, i
            at, size = i, 0
    if at < i:
        yield at, i


def _pieces(text: str, bpe: Bpe, chars: int) -> Iterator[tuple[int, str, str]]:
    """(pre-token number or -1, kind, piece): ``text`` between white space, or ``half``/``last`` of an unsplit pre-token."""
    raw, at, pre = text, 0, 0
    space = re.compile(r"[\x20\x09-\x0D]")
    while at < len(raw):
        if len(raw) - at <= chars:
            end = len(raw)
        else:
            m = space.search(raw, at + chars)
            end = m.end() if m else len(raw)
        piece = raw[at:end]
        if len(piece) <= 2 * chars:
            yield -1, "text", piece
        else:  # it holds an unsplit run
            for run in piece.split(" ") if not re.search(r"[\x09-\x0D]", piece) else re.split(r"[\x20\x09-\x0D]", piece):
                if len(run) <= chars:
                    yield -1, "text", run
                    continue
                for symbols, special in bpe.pretokens(run):
                    pre += 1
                    if special >= 0:
                        yield -1, "special", str(special)
                        continue
                    parts = bpe.halves(symbols)
                    for i, p in enumerate(parts):
                        yield pre, "last" if i == len(parts) - 1 else "half", p
        at = end


def encode_documents(docs: DataFrame, *, vocabulary: str | None = None, split_chars: int = SPLIT_CHARS, leaf: int = LEAF) -> DataFrame:
    """doc_id, n_tokens, ids (decimal ids joined by one space) and decoded for every row of ``docs``.

    A null text is empty; empty texts have 0 tokens.  Repeated rows give repeated rows.  Only
    doc_id and text are read.  The ids are those of the tokenizers library for the whole text
    without added special tokens, unused truncation and padding; decoded is its decode of them.
    """
    return _encoded(docs, vocabulary or default_vocabulary(), split_chars, leaf, False)


def digest_documents(docs: DataFrame, *, vocabulary: str | None = None, split_chars: int = SPLIT_CHARS, leaf: int = LEAF) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of ``encode_documents``, hashed where the ids are made."""
    return _encoded(docs, vocabulary or default_vocabulary(), split_chars, leaf, True)


def _encoded(docs: DataFrame, path: str, split_chars: int, leaf: int, digest: bool) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_tokens", *(["ids_sha256", "decoded_sha256"] if digest else ["ids", "decoded"])]
    schema = f"doc_id {kind}, n_tokens bigint, {names[2]} string, {names[3]} string"

    def result(ids, got: list[tuple[bytes, int, bytes]]) -> pa.RecordBatch:
        final = (lambda x: hashlib.sha256(x).hexdigest()) if digest else bytes.decode
        cols = [pa.array([g[1] for g in got], pa.int64()), pa.array([final(g[0]) for g in got], pa.string()), pa.array([final(g[2]) for g in got], pa.string())]
        return pa.record_batch([ids, *cols], names)

    @in_stage("bpe")
    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path, leaf)
        for b in batches:
            texts = b.column("text").cast(pa.binary())
            for i, j in _some(pc.binary_length(texts).to_pylist()):
                yield result(b.column("doc_id").slice(i, j - i), bpe.encode(texts.slice(i, j - i).to_pylist()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path, leaf)
        for b in batches:
            for r in range(b.num_rows):
                got = list(_pieces(b.column("text")[r].as_py(), bpe, split_chars))
                rows = b.slice(r, 1).select(["doc_id", "_hash"])
                same = [pa.concat_arrays([c] * len(got)) for c in rows.columns]
                yield pa.record_batch(
                    [*same, pa.array(range(len(got)), pa.int32()), pa.array([g[0] for g in got], pa.int32()), pa.array([g[1] for g in got]), pa.array([g[2] for g in got])],
                    ["doc_id", "_hash", "_no", "_pre", "_kind", "_piece"],
                )

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path, leaf)
        for b in batches:
            out = []
            for what, piece in zip(b.column("_kind").to_pylist(), b.column("_piece").to_pylist(), strict=True):
                if what == "text":
                    out.append(bpe.encode([piece.encode()])[0][0].decode())
                elif what == "special":
                    out.append(piece)
                else:
                    out.append(" ".join(map(str, bpe.symbols_ids(piece, what == "last"))))
            yield pa.record_batch([b.column(c) for c in ("doc_id", "_hash", "_no", "_pre")] + [pa.array(out, pa.string())], ["doc_id", "_hash", "_no", "_pre", "_ids"])

    def assemble(t: pa.Table) -> pa.Table:
        bpe = tokenizer(path, leaf)
        t = t.sort_by("_no")
        ids: list[int] = []
        open_leaves: list[list[int]] = []
        times, seen, open_pre = 0, -1, -1
        for no, pre, got in zip(t.column("_no").to_pylist(), t.column("_pre").to_pylist(), t.column("_ids").to_pylist(), strict=True):
            times += no == 0
            if no == seen:  # a repeated row
                continue
            seen, mine = no, [int(x) for x in got.split()]
            if pre != open_pre and open_leaves:
                ids += bpe.concat(open_leaves)
                open_leaves = []
            open_pre = pre
            if pre >= 0:
                open_leaves.append(mine)
            else:
                ids += mine
        ids += bpe.concat(open_leaves)
        return pa.Table.from_batches([result(pa.array([t.column("doc_id")[0].as_py()] * times, t.schema.field("doc_id").type), [bpe.entry(ids)] * times)])

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    long_text = F.char_length("text") > split_chars
    done = rows.filter(~long_text).mapInArrow(short, schema)
    pieces = rows.filter(long_text).withColumn("_hash", F.xxhash64("text")).mapInArrow(cut, f"doc_id {kind}, _hash bigint, _no int, _pre int, _kind string, _piece string")
    dealt = pieces.repartition(shuffle_width(docs.sparkSession), "doc_id", "_hash", "_no")
    encoded = dealt.mapInArrow(leaves, f"doc_id {kind}, _hash bigint, _no int, _pre int, _ids string")
    return done.union(encoded.groupBy("doc_id", "_hash").applyInArrow(assemble, schema))
