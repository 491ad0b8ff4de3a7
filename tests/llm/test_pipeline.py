"""The pipeline's stages on planted documents, each against a plain version."""

import random
from collections import Counter, defaultdict

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from afterglow.llm.catalogue import vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean documents with copies, a shared passage and a shared line, and junk; labels for most."""
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(3000)]
    clean = lambda n: "\n".join(" ".join(rng.choice(words) for _ in range(12)) + "." for _ in range(n))
    passage = " ".join(rng.choice(words) for _ in range(60))
    docs, labels, kinds = [], [], {}
    for i in range(400):
        kind = "junk" if i % 5 == 0 else "copy" if i % 37 == 1 and i > 2 else "passage" if i % 23 == 2 else "line" if i % 4 == 3 else "clean"
        text = clean(rng.randint(8, 20))
        if kind == "junk":
            text = " ".join(w + rng.choice(["&&&", "***", "%%%"]) for w in text.split())
        elif kind == "copy":
            text = docs[1][1]
        elif kind == "passage":
            text = text + " " + passage + " " + clean(3)
        elif kind == "line":
            text = "Subscribe to our letter\n" + text
        docs.append((i, text, "en", f"s{i % 3}", len(text)))
        kinds[i] = kind
        if i % 3:
            labels.append((i, int(kind != "junk"), 0))
    docs.append((1000, None, None, None, None))
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(docs, SCHEMA).coalesce(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{path}/labels.parquet")
    return path, {d[0]: d for d in docs}, kinds, passage


def test_stages(spark, folder):
    path, docs, kinds, passage = folder
    frame = spark.read.parquet(f"{path}/documents.parquet")
    stages = [f for _, f in corpus_pipeline.STAGES]
    kept = stages[0](spark, frame, path).cache()
    assert kept.columns == frame.columns
    ids = {r.doc_id for r in kept.collect()}
    clean = {i for i, k in kinds.items() if k != "junk"}
    assert ids <= clean and len(ids) > 0.97 * len(clean)

    lines = stages[1](spark, kept, path).cache()
    texts = {r.doc_id: r for r in lines.collect()}
    assert lines.columns == frame.columns and set(texts) == ids
    seen = Counter(x for i in ids for x in {y.strip().lower() for y in docs[i][1].split("\n")})
    for i in ids:
        want = "\n".join(x for x in docs[i][1].split("\n") if seen[x.strip().lower()] < 10)
        assert texts[i].text == want and texts[i].n_chars == len(want)

    one = stages[2](spark, lines, path).cache()
    by_text = defaultdict(set)
    for i in ids:
        by_text[texts[i].text].add(i)
    assert {r.doc_id for r in one.collect()} == {min(g) for g in by_text.values()} and one.columns == frame.columns

    spans = stages[3](spark, one, path).cache()
    windows = Counter()
    for r in one.collect():
        w = r.text.split()
        windows.update(tuple(w[j : j + 35]) for j in range(len(w) - 34))
    cut = 0
    for r in spans.collect():
        w = texts[r.doc_id].text.split()
        gone = {k for j in range(len(w) - 34) if windows[tuple(w[j : j + 35])] > 1 for k in range(j, j + 35)}
        cut += bool(gone)
        assert r.text == (" ".join(x for k, x in enumerate(w) if k not in gone) if gone else texts[r.doc_id].text)
    assert cut >= sum(kinds[r.doc_id] == "passage" for r in one.collect()) > 3

    tokenizer = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    rows = stages[4](spark, spans, path).collect()
    sizes = Counter()
    for r in rows:
        sizes[r.doc_id] += r.length
    assert sizes == Counter({r.doc_id: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in spans.collect()})
    assert sorted(map(tuple, corpus_pipeline.run(spark, path).select("doc_id", "piece", "start", "length", "ids_crc32").collect())) == sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)


def test_empty_documents(spark, tmp_path, folder):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
