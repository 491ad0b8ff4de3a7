"""Quality rules and classifier: base counts by brute force, defined edge cases, held-out accuracy."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from afterglow.llm import factorisation, quality

WORD = re.compile("[^\x20\x09-\x0d]+")
LABELS = "doc_id long, quality int, toxic int"


def base(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed


TEXTS = [None, "", " \n\t", "one", "a b c d e f g h " * 3 + "tail " * 9, "line\nline\n line\n\nline", "é ü 東京 # $ %%\x1c\x85x", "w " * 20, "same same\r\n" * 40,
         " ".join(f"x{i}" for i in range(30)), " ".join(f"x{i % 41}" for i in range(5000)), "\x0b".join("abcdefghijklmnopqrstuvwxyz")]


@pytest.mark.parametrize("labelled", [True, False])
def test_base_counts(spark, labelled):
    df = spark.createDataFrame([(i if i else None, t, "k") for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], "k")], "doc_id long, text string, kept string")
    labels = spark.createDataFrame([(9, 1, 0), (10, 0, 0), (11, None, 0), (None, 1, 0), (999, 0, 0)] if labelled else [], LABELS)
    got = quality.judge(df, labels).collect()
    assert len(got) == len(TEXTS) + 1
    for text, row in zip([*TEXTS, TEXTS[4]], got, strict=True):
        assert tuple(row)[1:7] == base(text), text
        assert not (row.kept and row.base_failed)
        if not labelled:
            assert row.kept is not row.base_failed
    kept = quality.keep_good(df, labels).collect()
    assert len(kept) == sum(r.kept for r in got) and all(r.kept == "k" for r in kept)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert quality.judge(none, labels).collect() == [] and quality.keep_good(none, labels).collect() == []


def test_forest_isolates_what_is_rare():
    rng = np.random.default_rng(3)
    rows = np.concatenate([rng.normal(0, 1, (960, 3)), rng.normal(9, 0.1, (40, 3))])
    good = np.arange(1000) < 960
    forest = quality.IsolationForest.fit(rows)
    forest.calibrate(rows, good)
    rejected = forest.score(rows) > forest.threshold
    assert rejected[~good].mean() > 0.95 and rejected[good].mean() < 0.01
    assert forest.score(rows[~good]).mean() > forest.score(rows[good]).mean()


def test_path_lengths_and_scores():
    """Scores against trees walked row by row; at the leaves, path lengths against counts of the tree's own rows."""
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(300, 3)).round(1)
    forest = quality.IsolationForest.fit(rows, trees=7, sample=64, seed=1)

    def harmonic(n):
        return 2 * sum(1 / i for i in range(1, n)) - 2 * (n - 1) / n if n > 1 else 0.0

    for n in (1, 2, 3, 10, 500):
        assert float(quality.IsolationForest.rest(n)) == pytest.approx(harmonic(n), abs=1e-3)

    def walked(tree, row):
        node = 0
        while forest.feature[tree, node] >= 0:
            node = 2 * node + 1 + int(row[forest.feature[tree, node]] >= forest.cut[tree, node])
        return node

    want = [2 ** (-np.mean([forest.length[t, walked(t, r)] for t in range(7)]) / harmonic(64)) for r in rows]
    assert forest.score(rows) == pytest.approx(want, rel=0.02)
    # with samples of all rows, each leaf's length is its level and the expected rest for the rows that end there
    forest = quality.IsolationForest.fit(rows[:40], trees=5, sample=40, seed=2)
    for t in range(5):
        ends = Counter(walked(t, r) for r in rows[:40])
        for node, count in ends.items():
            assert forest.length[t, node] == pytest.approx(int(np.log2(node + 1)) + float(quality.IsolationForest.rest(count)))


def test_threshold_by_brute_force():
    rng = np.random.default_rng(6)
    rows, good = rng.normal(size=(200, 2)), rng.random(200) < 0.8
    rows[~good] += 3
    forest = quality.IsolationForest.fit(rows, trees=20, sample=100)
    forest.calibrate(rows, good)
    score = forest.score(rows)
    gain = lambda cut: (score[~good] > cut).mean() - 10 * (score[good] > cut).mean()
    assert gain(forest.threshold) == pytest.approx(max(gain(c) for c in [*score.tolist(), 1.0]))


def test_pairs_in_linear_time():
    rng = np.random.default_rng(1)
    size = factorisation.WORD_BUCKETS + 2 * factorisation.STEPS + factorisation.LENGTH_BUCKETS
    machine = factorisation.Machine(np.zeros((2, factorisation.STEPS - 1)), 0.3, rng.normal(size=size), rng.normal(size=(size, 5)))
    rows = factorisation.Rows(np.array([0, 4, 11]), rng.integers(0, size, 11), rng.normal(size=11))
    raw, _ = machine.raw(rows)
    for r in range(2):
        part = range(rows.edges[r], rows.edges[r + 1])
        want = 0.3 + sum(machine.w[rows.index[i]] * rows.value[i] for i in part)
        want += sum(machine.v[rows.index[i]] @ machine.v[rows.index[j]] * rows.value[i] * rows.value[j] for i in part for j in part if i < j)
        assert raw[r] == pytest.approx(want)


def test_classifier_edges(spark):
    df = spark.createDataFrame([(i if i else None, t, "x", 5) for i, t in enumerate(TEXTS)], "doc_id long, text string, score string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 12)] + [(None, 1, 0), (3, None, 0)], LABELS)
    got = factorisation.classify(df, labels).collect()
    assert len(got) == len(TEXTS)
    for i, row in enumerate(got):
        assert row.held_out == (zlib.crc32(str(i).encode() if i else b"") % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.3)
    assert {r.score for r in factorisation.classify(df.drop("n_chars"), labels.limit(0)).collect()} == {0.5}
    assert factorisation.classify(spark.createDataFrame([], "doc_id long, text string"), labels).collect() == []


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    held = factorisation.classify(docs, labels).join(labels, "doc_id").filter("held_out").select("predicted", "quality", "score").collect()
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.95
    judged = quality.judge(docs, labels).filter("NOT base_failed").join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    share = {r.quality: r.kept for r in judged}
    assert share[1] > 0.97 and share[0] < 0.2


def thue_morse(bits):
    """Two words of 2^bits letters whose sums of letters times powers agree modulo 2^64, whatever the base."""
    word = "a"
    for _ in range(bits):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_lines_and_words_are_told_apart(spark):
    a, b = thue_morse(10)
    for text, repeats in ((f"{a}\n{b}", 0), (f"{a}\n{b}\n{a}", 1), (f"{a} x y z u v w t\n{b} x y z u v w t", 0)):
        row = quality.judge(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([], LABELS)).first()
        assert tuple(row)[1:7] == base(text) and row.n_dup_lines == repeats
