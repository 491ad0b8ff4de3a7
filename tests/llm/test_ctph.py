"""Fingerprints: edit distances, next documents and likeness against plain versions."""

import hashlib
import random

import numpy as np
import pytest

from afterglow.llm import ctph


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_edit_distances():
    rng = random.Random(1)
    pairs = [(bytes(rng.choice(b"ABCD") for _ in range(rng.randint(0, 64))), bytes(rng.choice(b"ABCD") for _ in range(rng.randint(0, 64)))) for _ in range(300)]
    pairs += [(b"", b""), (b"", b"A"), (b"A" * 64, b""), (b"A" * 64, b"A" * 64)]
    assert ctph.edit_distances(pairs).tolist() == [levenshtein(a, b) for a, b in pairs]


TEXTS = {5: None, -3: "", 9: "é", 2: "ab", 7: "naïve 東京 text " * 40, 100: "x" * 30_000, 11: "short", 12: "word " * 999, 13: "word " * 999}


def expected(texts):
    """Rows for texts in order."""
    out = []
    for i, (key, t) in enumerate(texts):
        t, nxt = t or "", texts[(i + 1) % len(texts)][1] or ""
        half = len(t) // 2
        changed = t[: len(t) - half] + nxt[:half]
        sig = [ctph.signatures(np.frombuffer(x.encode(), np.uint8)) for x in (t, changed, nxt)]
        near = ctph.likeness([(sig[0], sig[1]), (sig[0], sig[2])]).tolist()
        out.append((key, len(t), hashlib.sha256(changed.encode()).hexdigest(), ctph.written(sig[0]), ctph.written(sig[1]), *near))
    return out


@pytest.mark.parametrize("parts", [1, 3, 8, 40])
def test_next_document_in_any_partitioning(spark, parts):
    rows = [(k, t, "x") for k, t in TEXTS.items()]
    random.Random(parts).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string").repartition(3)
    got = sorted(map(tuple, ctph.compare_with_next(df, parts).collect()))
    assert got == sorted(expected(sorted((k, t) for k, t in TEXTS.items())))


def test_nulls_repeats_one_and_none(spark):
    schema = "doc_id long, text string"
    rows = [(None, "aa"), (None, "bb"), (1, "zz"), (1, "zz"), (1, "cc"), (2, None)]
    got = ctph.compare_with_next(spark.createDataFrame(rows[::-1], schema), 4).collect()
    order = [(None, "aa"), (None, "bb"), (1, "cc"), (1, "zz"), (1, "zz"), (2, None)]
    assert sorted(map(tuple, got), key=str) == sorted(expected(order), key=str)
    one = ctph.compare_with_next(spark.createDataFrame([(4, "abcd")], schema)).collect()
    assert [tuple(r) for r in one] == expected([(4, "abcd")]) and one[0].near_next == 1.0
    assert ctph.compare_with_next(spark.createDataFrame([], schema)).collect() == []


def test_likeness_follows_edits():
    rng = random.Random(2)
    make = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "tau"]) + str(rng.randint(0, 99)) for _ in range(n)).encode()
    sig = lambda b: ctph.signatures(np.frombuffer(b, np.uint8))
    for n in (30, 300, 5000):
        a, b = make(n), make(n)
        little = a[: len(a) // 2] + b"XX" + a[len(a) // 2 :]
        half = a[: len(a) // 2] + b[: len(a) // 2]
        near = ctph.likeness([(sig(a), sig(a)), (sig(a), sig(little)), (sig(a), sig(half)), (sig(a), sig(b))])
        assert near[0] == 1 and near[1] > 0.85 and 0.35 < near[2] < 0.75 and near[3] < 0.3
    assert all(len(s) <= 64 for s in sig(b"ab" * 50_000)[1:])
