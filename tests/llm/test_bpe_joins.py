"""BPE: joins of halves on ordinary texts, the two-generation table, caches of other stages."""

import random

import pytest

from pairforge.llm import bpe, common


def texts():
    rng = random.Random(7)
    words = ["the", "naïve", "日本語テキスト", "don't", "x" * 40, "👍🏽👍", "a", "12345", "É", "<|endoftext|>", "well-known"]
    gaps = [" ", "\n", "\t ", "  ", "\r\n"]
    out = ["", " ", "a", "x" * 5000, " " * 300, "日" * 900, "é" * 700 + " end"]
    return out + ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(1, 400))) for _ in range(40)]


@pytest.mark.parametrize("cut", [8, 64, 1000])
def test_halves_join_to_the_whole(cut):
    own = bpe.Bpe(bpe.default_vocabulary(), leaf=16, cut=cut)
    rows = texts()
    got = own.encode([t.encode() for t in rows])
    for t, (ids, n, decoded) in zip(rows, got, strict=True):
        want = own.whole.encode(t, add_special_tokens=False).ids
        assert [int(x) for x in ids.split()] == want and n == len(want)
        assert decoded.decode() == own.whole.decode(want, skip_special_tokens=False)
    assert own.joins > 50  # the joins run on ordinary texts


def test_runs_are_those_of_the_whole_text():
    own = bpe.Bpe(bpe.default_vocabulary(), cut=8)
    for t in texts():
        assert own.runs(t.encode()) == t.encode().split()


def test_a_tokenizer_that_reaches_across_white_space_is_refused():
    own = bpe.Bpe(bpe.default_vocabulary())
    own._ids = lambda runs: [len(runs)]
    with pytest.raises(ValueError, match="white space"):
        own.joined([b"a", b"b", b"c"], [b"d", b"e"])


def test_known_runs_live_for_two_generations(monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_RUNS", 20)
    own = bpe.Bpe(bpe.default_vocabulary())
    for i in range(60):
        text = f"often r{i} s{i} t{i}"
        assert own.encode_ids(text) == own.whole.encode(text, add_special_tokens=False).ids
    assert b"often" in own.known and len(own.known) + len(own.older) <= 2 * 20 + 8
    made = []
    real = own.whole.encode_batch_fast
    own.whole = type("Spy", (), {"encode_batch_fast": lambda self, x, **k: made.extend(x) or real(x, **k)})()
    own.encode([b"often often"])
    assert made == []


def test_another_stage_frees_what_a_stage_kept():
    common.stage_begins("bpe")
    kept = bpe.tokenizer(bpe.default_vocabulary())
    common.stage_begins("bpe")
    assert bpe.tokenizer(bpe.default_vocabulary()) is kept
    common.stage_begins("jaccard")
    assert bpe.tokenizer.cache_info().currsize == 0


def test_workers_give_back_at_the_end_of_a_task(monkeypatch):
    """pipeline: workers idle beside the JVM's shuffles, and hold no other operator's table."""
    freed, back = [], []
    monkeypatch.setattr(common, "CACHES", {"bpe": lambda: freed.append("bpe")})
    monkeypatch.setattr(common, "give_back", lambda collect=True: back.append(collect))
    common.stage_begins("bpe")
    del back[:]
    task = common.in_stage("toxicity")(lambda batches: (b + 1 for b in batches))
    assert list(task(iter([1, 2]))) == [2, 3] and freed[-1] == "bpe" and back == [True, False]
    assert list(task(iter([]))) == [] and back == [True, False, False]
    assert list(bpe._some([3, 3, 10, 1], 6)) == [(0, 2), (2, 3), (3, 4)] and list(bpe._some([], 6)) == []
