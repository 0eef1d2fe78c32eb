"""Plain versions of what the classifiers and the fingerprint compute: evidence, severity, likeness."""

import math
import random

import numpy as np
import pytest
import zstandard

from pairforge.llm import fingerprint, quality, toxicity
from tests.llm.test_operators import docs_of, odd_texts

DICTS = ("the good and careful sentence about rivers " * 40).encode(), ("click here buy now !!! free $$$ " * 40).encode()


def plain_evidence(text, good, bad):
    raw, total = (text or "").encode(), 0
    for at in range(0, len(raw), quality.BLOCK_BYTES):
        block, size = raw[at : at + quality.BLOCK_BYTES], {}
        for name, d in (("good", good), ("bad", bad)):
            c = zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False)
            size[name] = len(c.compress(block))
        total += size["bad"] - size["good"]
    return total / len(raw) if raw else 0.0


def test_quality_score_is_the_curve_at_the_plain_evidence(spark):
    rows = [*odd_texts(), (20, "the good and careful sentence about rivers", "a"), (21, "click here buy now !!! free $$$", "a"), (22, "rivers and free $$$ " * 20_000, "a")]
    model = quality.QualityModel(*DICTS, 9.0, 0.3)
    got = quality.score(docs_of(spark, rows), model).collect()
    assert len(got) == len(rows)
    want = sorted((str(d), 1 / (1 + math.exp(-(9.0 * plain_evidence(t, *DICTS) + 0.3)))) for d, t, _ in rows)
    assert all(a == c and abs(b - e) < 1e-12 for (a, b), (c, e) in zip(sorted((str(r.doc_id), r.score) for r in got), want, strict=True))
    assert {r.doc_id: r.held_out for r in got}[None] is False
    # a tie at the threshold counts as good
    at = quality.score(docs_of(spark, [(1, "", "a")]), quality.QualityModel(b"", b"", 0.0, math.log(0.7 / 0.3)), threshold=1 / (1 + math.exp(-math.log(0.7 / 0.3)))).first()
    assert at.predicted == 1


@pytest.mark.parametrize("thresholds", [[0.5], [-0.2, 0.9], [0.1, 0.2, 2.5]])
def test_severity_is_the_expected_grade(spark, thresholds):
    words, weights = {"foo": 0, "bar": 1, "bar-": 2, "baz-": 3}, np.array([1.5, -0.7, 0.4, 0.25])
    model = toxicity.OrdinalModel(words, weights, np.array(thresholds))
    rows = [*odd_texts(), (30, "Foo foo bar", "a"), (31, "bazaar bazar foo " * 9000, "a"), (32, "foo", "a"), (32, "foo", "a")]
    for r in toxicity.score(docs_of(spark, rows), model).collect():
        counts = np.zeros(4)
        for w in toxicity.WORD.findall((r.text or "").lower()):
            for t in [w, *[w[:n] + "-" for n in toxicity.BEGINNINGS if len(w) >= n]]:
                if t in words:
                    counts[words[t]] += 1
        s = float(np.log1p(counts) @ weights)
        atleast = [1.0, *(1 - 1 / (1 + math.exp(-(t - s))) for t in thresholds), 0.0]
        each = [a - b for a, b in zip(atleast[:-1], atleast[1:], strict=True)]
        assert abs(r.severity - sum(g * p for g, p in enumerate(each))) < 1e-9 and abs(r.p_toxic - (1 - each[0])) < 1e-9
        assert r.grade == int(np.argmax(each)) and r.rejected == (r.p_toxic >= 0.5)


def test_graded_labels_get_a_threshold_each_and_binary_ones_one(spark):
    rng = random.Random(4)
    rows, graded, binary = [], [], []
    for i in range(400):
        grade = i % 3
        rows.append((i, " ".join(rng.choice(["calm", "plain", "word", "text"]) for _ in range(20)) + " awful" * (3 * grade) + " vile" * (5 * (grade == 2)), "a"))
        graded.append((i, grade))
        binary.append((i, min(grade, 1)))
    df = docs_of(spark, rows)
    three = toxicity.fit(df, spark.createDataFrame(graded, "doc_id bigint, toxic int"))
    two = toxicity.fit(df, spark.createDataFrame(binary, "doc_id bigint, toxic int"))
    assert len(three.thresholds) == 2 and (np.diff(three.thresholds) > 0).all() and len(two.thresholds) == 1
    got = {r.doc_id: r for r in toxicity.score(df, three).collect()}
    assert sum(got[i].grade == i % 3 for i in range(400)) > 380
    assert all(r.severity == r.p_toxic and r.grade in (0, 1) for r in toxicity.score(df, two).collect())


def plain_distance(a, b):
    """Insertions and deletions that turn a into b."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(before[j - 1] if x == y else 1 + min(before[j], row[j - 1]))
    return row[-1]


def test_likeness_is_the_plain_edit_distance():
    rng = random.Random(6)
    for _ in range(400):
        a = "".join(rng.choice("ABCDEF") for _ in range(rng.randint(0, 96)))
        b = "".join(c for c in a if rng.random() > 0.15) if rng.random() < 0.6 else "".join(rng.choice("ABCDEF") for _ in range(rng.randint(0, 96)))
        n = min(fingerprint.COMMON, len(a), len(b))
        common = n > 0 and any(a[i : i + n] in b for i in range(len(a) - n + 1))
        want = 1.0 if a == b else 1 - plain_distance(a, b) / (len(a) + len(b)) if common else 0.0
        assert abs(fingerprint._likeness(a, b) - want) < 1e-12 and fingerprint._likeness(a, b) == fingerprint._likeness(b, a)


def test_fingerprint_odd_neighbours(spark):
    one = fingerprint.compare_with_next(docs_of(spark, [(5, "only row", "a")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0  # its next document is itself
    rows = [(None, "no id at all", "a"), (3, "three", "a"), (3, "three", "a"), (1, "", "b")]
    got = fingerprint.compare_with_next(docs_of(spark, rows)).collect()
    assert len(got) == 4 and {r.doc_id for r in got} == {None, 1, 3}
    assert len({r.fingerprint for r in got if r.doc_id == 3}) == 1
