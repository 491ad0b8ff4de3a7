"""SimHash against brute force over all pairs."""

import itertools
import random

import numpy as np
import xxhash

from afterglow.llm import simhash


def brute_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    out = 0
    for bit in range(64):
        ones = sum(xxhash.xxh64_intdigest(s.encode(), 42) >> bit & 1 for s in shingles)
        out |= (2 * ones > len(shingles)) << bit
    return out


def brute_components(fps, radius=2):
    root = list(range(len(fps)))
    for _ in fps:
        for i, j in itertools.combinations(range(len(fps)), 2):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[i] = root[j] = min(root[i], root[j])
    return root


def test_masks_cover_every_pair_of_bits():
    for depth in (1, 2, 3):
        masks = simhash.tables(depth)
        for i, j in itertools.combinations_with_replacement(range(64), 2):
            assert any(not m >> i & 1 and not m >> j & 1 for m in masks)
    assert min(m.bit_count() for m in simhash.tables(3)) >= 58
    rng = np.random.default_rng(1)
    for radius in (3, 5):
        masks = simhash.tables(1, radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for bits in rng.integers(0, 64, (500, radius)).tolist():
            differing = sum(1 << b for b in set(bits))
            assert any(not m & differing for m in masks)


def test_documents_match_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    base = [" ".join(rng.choice(words) for _ in range(90)) for _ in range(12)]
    texts = [None, "", " \n", "one", "ONE two", *base, *base[:4]]
    for t in base[:9]:
        for _ in range(4):
            parts = t.split()
            parts[rng.randrange(len(parts))] = "Changed"
            texts.append("\n".join(parts).upper())
    df = spark.createDataFrame([(i, t, "f") for i, t in enumerate(texts)], "doc_id long, text string, fingerprint string")
    fps = [brute_fingerprint(t) for t in texts]
    want = [(i, f"{fp:016x}", c) for i, (fp, c) in enumerate(zip(fps, brute_components(fps), strict=True))]
    assert sorted(map(tuple, simhash.near_duplicates(df).collect())) == want


def test_links_of_clustered_fingerprints_survive_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET_LIMIT", 4)
    rng = np.random.default_rng(2)
    centre = int(rng.integers(0, 1 << 63))
    fps = sorted({centre ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for a, b, c in rng.integers(0, 64, (70, 3))})
    df = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    found = {r.node: r.root for r in simhash.components(simhash.links(df)).collect()}
    want = brute_components(fps)
    groups, expect = {}, {}
    for i, f in enumerate(fps):
        s = simhash.signed(f)
        groups.setdefault(found.get(s, s), set()).add(s)
        expect.setdefault(want[i], set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expect.values()))


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(900, 901), (901, 901)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {901: 900}


def test_nulls_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (None, "other words here now")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == [(7, 7), (7, 7), (None, 7), (None, None)]
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_keep_one_of_each_group(spark):
    base = [" ".join(f"w{i}x{j}" for j in range(300)) for i in range(5)]
    rows = [(10 * i, t, "c") for i, t in enumerate(base)] + [(10 * i + 1, t.replace(f"w{i}x150", "edit"), "c") for i, t in enumerate(base)]
    rows += [(7, base[0], "c"), (7, base[0], "c"), (2, "", "c"), (3, None, "c"), (None, "", "c"), (None, base[1], "c")]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, fp string")).collect()
    named = sorted({(i, t or "") for i, t, _ in rows if i is not None})
    fps = [simhash.fingerprint(simhash.shingle_hashes(t.encode(), 5)) for _, t in named]
    want = {named[j][0] for i, j in enumerate(brute_components(fps, 5)) if i == j}
    assert want >= {0, 2, 10, 20, 30, 40} and 7 not in want and len(want) < 10
    assert sorted((r.doc_id for r in got), key=str) == sorted([*want, None, None], key=str)
    assert {r.fp for r in got} == {"c"}


def test_unlike_texts_of_one_component_stay(spark, monkeypatch):
    rows = [(1, "a b c d e f g h"), (2, "a b c d e f g h"), (3, "z y x w v u t s"), (4, ""), (5, " ")]
    monkeypatch.setattr(simhash, "sketches", lambda docs, width, bands: docs.selectExpr("doc_id", "digest", "7L AS fp", "cast(array() AS array<long>) AS keys"))
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in got) == [1, 3, 4, 5]
    assert simhash.similarity(b"", b" ", 5) == 1.0 and simhash.similarity(b"a", b"", 5) == 0.0
    long = " ".join(map(str, range(100))).encode()
    assert abs(simhash.similarity(long, long.replace(b"50", b"x"), 5) - 91 / 101) < 1e-9


def kept_by_brute_force(texts, least=0.8):
    """Places of the texts that stay, and the pairs of different texts at least so similar."""
    sets = [set(simhash.shingle_hashes(t.encode(), 5).tolist()) for t in texts]
    pairs = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j])]
    root = list(range(len(texts)))
    for _ in texts:
        for i, j in pairs:
            root[i] = root[j] = min(root[i], root[j])
    return {i for i, r in enumerate(root) if i == r}, pairs


def test_pairs_at_similarity_are_found(spark):
    """Edited copies of many texts, from 0.8 upwards, far beyond the fingerprints' five bits: all pairs of brute force."""
    rng = random.Random(3)
    texts = []
    for i in range(60):
        words = [f"w{i}x{rng.randrange(2000)}" for _ in range(200)]
        texts.append(" ".join(words))
        for at in rng.sample(range(200), rng.randint(1, 4)):
            words[at] = "edit"
        texts.append(" ".join(words))
    want, pairs = kept_by_brute_force(texts)
    fps = [simhash.fingerprint(simhash.shingle_hashes(t.encode(), 5)) for t in texts]
    assert len(pairs) > 50 and sum((fps[i] ^ fps[j]).bit_count() > 5 for i, j in pairs) > 15
    got = simhash.keep_one(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), bands=True).collect()
    assert {r.doc_id for r in got} == want


def test_drifting_group_goes_to_one(spark):
    """Forty versions of a text, two words changed from each to the next, every version twice, in no order."""
    rng = random.Random(4)
    words = [f"v{rng.randrange(5000)}" for _ in range(400)]
    versions = []
    for _ in range(40):
        for at in rng.sample(range(400), 2):
            words[at] = f"e{rng.randrange(10**6)}"
        versions += [" ".join(words)] * 2
    rng.shuffle(versions)
    want, _ = kept_by_brute_force(versions)
    df = spark.createDataFrame(list(enumerate(versions)), "doc_id long, text string")
    for bands in (True, False):
        got = [r for r in simhash.keep_one(df, bands=bands).collect()]
        assert len({r.text for r in got}) == len(got)
        if bands:
            assert {r.doc_id for r in got} == want == {0}


def test_unlike_texts_of_one_doc_id_stay(spark):
    texts = {(1, "a b c d e f g h i j"), (1, "k l m n o p q r s t"), (2, "a b c d e f g h i j"), (2, "other words of the second one"), (3, None), (4, ""), (None, "a b c d e f g h i j")}
    rows = [(i, t, "k", "n", i) for i, t in [*sorted(texts, key=str), (1, "a b c d e f g h i j")]]
    df = spark.createDataFrame(rows, "doc_id long, text string, digest string, __n string, __row long")
    got = simhash.keep_one(df, bands=True)
    assert got.columns == df.columns
    want = [(1, "a b c d e f g h i j"), (1, "k l m n o p q r s t"), (2, "other words of the second one"), (3, None), (None, "a b c d e f g h i j")]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(want, key=str)
    assert simhash.keep_one(df.limit(0), bands=True).collect() == []


def test_crowded_buckets_at_radius_five(spark, monkeypatch):
    """Fingerprints crowded into a few buckets link as by brute force, and no bucket that is compared is large."""
    monkeypatch.setattr(simhash, "BUCKET_LIMIT", 16)
    rng = np.random.default_rng(4)
    centre = int(rng.integers(0, 1 << 63))
    fps = sorted({centre ^ sum(1 << int(b) for b in set(bits)) for bits in rng.integers(0, 12, (150, 7)).tolist()} | {int(x) for x in rng.integers(0, 1 << 62, 20)})
    found = {r.node: r.root for r in simhash.components(simhash.links(spark.createDataFrame([(simhash.signed(f),) for f in fps] + [(None,)], "fp long"), 5)).collect()}
    want = brute_components(fps, 5)
    groups, expect = {}, {}
    for i, f in enumerate(fps):
        s = simhash.signed(f)
        groups.setdefault(found.get(s, s), set()).add(s)
        expect.setdefault(want[i], set()).add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expect.values()))
    for kept in (0, (1 << 32) - 1, (1 << 48) - 1, (1 << 55) - 1):
        masks = simhash.masks_beyond(kept, 5)
        assert all((m & ~kept).bit_count() >= 1 and m & kept == kept for m in masks)
        for bits in rng.integers(kept.bit_length(), 64, (300, 5)).tolist():
            assert any(not m & sum(1 << b for b in set(bits)) for m in masks)


def test_texts_far_apart_in_a_crowded_bucket_are_found(spark, monkeypatch):
    """Versions of one text about 0.8 alike, far more than the neighbours that a first pass compares: groups of brute force."""
    for name, value in (("NEIGHBOURS", 1), ("BLOCK", 5), ("TILE", 7)):
        monkeypatch.setattr(simhash, name, value)
    rng = random.Random(6)
    base = [f"b{i}" for i in range(300)]
    texts = []
    for _ in range(90):
        words = list(base)
        for at in rng.sample(range(300), rng.randint(2, 6)):
            words[at] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    want, pairs = kept_by_brute_force(texts)
    assert 1 < len(want) < 60 and pairs
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id for r in simhash.keep_one(df, bands=True).collect()}
    monkeypatch.setattr(simhash, "apart_in_crowded", lambda members, wide, least: members.select(members["id"].alias("a"), members["id"].alias("b")).limit(0))
    without = {r.doc_id for r in simhash.keep_one(df, bands=True).collect()}
    assert got == want and got < without
