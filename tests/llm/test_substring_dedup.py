"""Substring dedup against brute force."""

import random
from collections import Counter

import pytest

from afterglow.llm import substring_dedup as sd


def brute(texts, window):
    docs = [(t or "").replace("\t", " ").replace("\n", " ").split(" ") for t in texts]
    docs = [[w for w in d if w] for d in docs]
    seen = Counter(tuple(d[i : i + window]) for d in docs for i in range(len(d) - window + 1))
    out = []
    for d in docs:
        gone = set()
        for i in range(len(d) - window + 1):
            if seen[tuple(d[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((" ".join(w for i, w in enumerate(d) if i not in gone), len(d), len(gone)))
    return out


def corpus(seed, window):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    make = lambda n: [rng.choice(words) for _ in range(n)]
    passages = [make(n) for n in (window - 1, window, window + 1, 3 * window)]
    docs = [make(rng.randint(0, 150)) for _ in range(40)]
    for _ in range(60):
        docs.append(make(rng.randint(0, 30)) + rng.choice(passages) + make(rng.randint(0, 30)))
    docs += [docs[3], docs[3], passages[3] * 3, ["same"] * 200, docs[50][:-1] + ["edited"], docs[50][10:]]
    texts = [rng.choice([" ", "\n", " \t"]).join(d) for d in docs] + [None, "", " \n", "é ü " * 30]
    rng.shuffle(texts)
    return texts


def result(spark, texts, window):
    df = spark.createDataFrame([(i if i else None, t, i, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_words int, gone string")
    got = sd.without_repeats(df, window).collect()
    assert {r.gone for r in got} <= {"x"}
    return [(r.kept_text, r.n_words, r.n_removed) for r in sorted(got, key=lambda r: r.doc_id or 0)]


@pytest.mark.parametrize(("window", "limit"), [(35, 256), (6, 256), (6, 2), (35, 1), (80, 256)])
def test_matches_brute_force(spark, monkeypatch, window, limit):
    monkeypatch.setattr(sd, "SHARD_SEGMENTS", limit)
    texts = corpus(window + limit, window)
    assert result(spark, texts, window) == brute(texts, window)


def test_automaton_counts_every_substring():
    rng = random.Random(8)
    for _ in range(60):
        texts = [[rng.choice("ab") for _ in range(rng.randint(1, 12))] for _ in range(rng.randint(1, 4))]
        weights = [rng.randint(1, 3) for _ in texts]
        automaton = sd.SuffixAutomaton()
        for t, n in zip(texts, weights, strict=True):
            automaton.add(t, n)
        automaton.close()
        for size in range(1, 6):
            for probe in texts + [list("abba")]:
                want = [sum(n for t, n in zip(texts, weights, strict=True) for i in range(len(t) - size + 1) if t[i : i + size] == probe[e - size + 1 : e + 1]) if e >= size - 1 else 0 for e in range(len(probe))]
                assert list(automaton.occurrences(probe, size)) == want


def test_repeated_rows_and_empty_table(spark):
    text = " ".join(f"t{i}" for i in range(50))
    df = spark.createDataFrame([(1, text), (1, text), (2, "short")], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_removed, r.kept_text) for r in sd.without_repeats(df).collect()) == [(1, 50, ""), (1, 50, ""), (2, 0, "short")]
    assert sd.without_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_words_that_sum_alike_differ(spark):
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    same = [f"w{i}" for i in range(17)]
    texts = [" ".join([*same, x, *same]) for x in (word, other)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.n_removed for r in sd.without_repeats(df, 35).collect()] == [0, 0]
    assert [r.n_removed for r in sd.without_repeats(df.unionAll(df.filter("doc_id = 0")), 35).orderBy("doc_id").collect()] == [35, 35, 0]


def test_clashing_names_and_hot_anchors(spark, monkeypatch):
    from afterglow.llm import spread

    monkeypatch.setattr(spread, "HOT_SHARE", 20)
    monkeypatch.setattr(sd, "SHARD_SEGMENTS", 5)
    texts = corpus(8, 10)
    rows = [(i, t, f"a{i}", f"b{i}", f"c{i}", i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __k1 string, __gone string, __key string, anchor long")
    got = sorted(sd.without_repeats(df, 10).collect(), key=lambda r: r.doc_id)
    assert [(r.kept_text, r.n_words, r.n_removed) for r in got] == brute(texts, 10)
    assert [tuple(r)[:6] for r in got] == rows


def test_near_copies_give_a_window_one_row_a_shard(spark, monkeypatch):
    """Segments of a crowded anchor settle their windows within shards, not by a row for each segment and window."""
    monkeypatch.setattr(sd, "SHARD_SEGMENTS", 50)
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for i in range(200):
        words = list(passage)
        for k in rng.sample(range(60), 2):
            words[k] = f"e{i}x{k}"
        texts.append(" ".join(words))
    judged, most = sd._judged, []

    def spy(*given):
        out = judged(*given)
        most.append(out.filter("window IS NOT NULL").groupBy("window").count().agg({"count": "max"}).first()[0])
        return out

    monkeypatch.setattr(sd, "_judged", spy)
    assert result(spark, texts, 10) == brute(texts, 10)
    assert 2 <= most[0] <= 4  # 200 segments of an anchor at most, by 50
