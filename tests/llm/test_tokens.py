"""Token operators against the libraries themselves."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from afterglow.llm import packing, piece_bpe, sentencepiece_ops

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "   two  spaces ", "a\nb\n\n c", "▁x", "naïve café — 東京 😀", "\x00a\tb\r\n", "<s> a </s> <unk> <0x0A>", "<|endoftext|> x",
    "a  b \n\nc", "it's we'll I'D 12 345", " " * 40 + "x", "word " * 3000, "same", "same",
]


def frame(spark, texts=TEXTS):
    return spark.createDataFrame([(i if i != 3 else None, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_prefix_table_equals_library_on_random_text(library):
    model, rng = piece_bpe.piece_model(MODEL), random.Random(3)
    pieces = list(model.ids)
    alphabet = list("abcdeilnrstou  \n'▁.,-0123é世😀\tА<>") + ["the", " th", "  ", "tion", "\x00"]
    for n in range(6000):
        text = "".join(rng.choice(alphabet if n % 2 else pieces) for _ in range(rng.randint(0, 20)))
        ids = library.encode(text)
        assert model.encode(text) == ids
        assert model.decode(ids) == library.decode(ids)


def test_encode_documents(spark, library):
    rows = sentencepiece_ops.encode_documents(frame(spark), MODEL).collect()
    assert len(rows) == len(TEXTS)
    digests = sentencepiece_ops.encode_documents(frame(spark), MODEL, digest=True).collect()
    for text, row, digest in zip(TEXTS, rows, digests, strict=True):
        ids = library.encode(text or "")
        assert row.ids == ids and row.n_tokens == len(ids) and row.decoded == library.decode(ids)
        assert digest.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert digest.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


@pytest.mark.parametrize("head", [400_000, 3, 0])
def test_count_tokens(spark, library, head):
    texts = [*TEXTS, "x" * 700 + " " + "long" * 90 + "\n" * 300]
    rows = sentencepiece_ops.count_tokens(frame(spark, texts), MODEL, limit=100, head_entries=head).collect()
    want = []
    for i, text in enumerate(texts):
        n = len(library.encode(text or ""))
        want.append((i if i != 3 else None, len((text or "").encode()), n, n > 100))
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)


def test_pre_token_table_counts_each_once(spark, library):
    table = {r.chunk: (r.n, r.pieces) for r in sentencepiece_ops.pre_token_table(frame(spark, ["to be or not to be", "be\nbe", None]), MODEL).collect()}
    assert {c: n for c, (n, _) in table.items()} == {"▁to": 2, "▁be": 3, "▁or": 1, "▁not": 1, "\n": 1, "be": 1}
    assert sentencepiece_ops.most_frequent(spark.createDataFrame([("a", 9, 1), ("b", 4, 2), ("c", 5, 3), ("d", 1, 4)], "chunk string, n long, pieces long"), 3) == {"a": 1, "b": 2, "c": 3}


def test_long_texts_in_parts(library):
    rng = random.Random(6)
    model = piece_bpe.piece_model(MODEL)
    for _ in range(400):
        text = "".join(rng.choice(["word", " ", "  ", "\n", "\n\n", "é東", "▁", "a"]) for _ in range(rng.randint(0, 40)))
        for size in (1, 5, 17):
            parts = list(piece_bpe.pre_token_parts(text.encode(), size))
            assert [c for p in parts for c in p] == piece_bpe.PRE_TOKEN.findall(piece_bpe.marked(text)), (text, size)
            assert [i for p in parts for c in p for i in model.encode_pre_token(c)] == library.encode(text)


@pytest.mark.parametrize("operator", [sentencepiece_ops.count_tokens, sentencepiece_ops.encode_documents])
def test_empty_table(spark, operator):
    assert operator(frame(spark, []), MODEL).collect() == []


def test_pieces_are_the_tokenizers_ids(spark):
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    rows = packing.pack(frame(spark), BYTE_BPE, size=256, with_ids=True).collect()
    want = sorted(tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (0,) for t in TEXTS)
    docs = defaultdict(list)
    for row in rows:
        assert len(row.ids) == row.length and zlib.crc32(np.array(row.ids, "<u4").tobytes()) == row.ids_crc32
        docs[row.doc_id if row.doc_id not in (14, 15) else 14].append(row)
    got = []
    for key, pieces in docs.items():
        pieces.sort(key=lambda r: (r.piece, r.start))
        if key == 14:  # two equal one-piece documents
            got += [tuple(p.ids) for p in pieces]
            continue
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        assert all(p.start == sum(q.length for q in pieces[:n]) for n, p in enumerate(pieces))
        assert all(p.length == 256 for p in pieces[1:])
        got.append(tuple(i for p in pieces for i in p.ids))
    assert sorted(got) == want
    check_sequences(rows, 256)


def check_sequences(rows, size):
    placed = defaultdict(list)
    for row in rows:
        placed[row.sequence_id].append((row.offset, row.length))
    for parts in placed.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(placed)


def test_plan_covers_the_histogram_in_few_sequences():
    rng = np.random.default_rng(1)
    for lengths in (rng.integers(1, 2049, 20_000), np.minimum(2048, rng.lognormal(6, 1, 5_000)).astype(int) + 0, np.full(999, 700), np.array([], int)):
        counts = np.bincount(lengths, minlength=2049)
        plan = packing.plan_sequences(counts, 2048)
        seen = np.zeros(2049, int)
        for pattern, times in plan:
            assert sum(pattern) <= 2048
            for n in pattern:
                seen[n] += times
        assert (seen == counts).all()
        used, least = sum(n for _, n in plan), int(np.ceil(lengths.sum() / 2048))
        if len(set(lengths)) > 1:
            assert used <= least * 1.01 + 2 or used <= (lengths > 1024).sum() + least * 0.02


def test_packing_one_hot_length_and_empty(spark):
    rows = packing.pack(frame(spark, ["one two three"] * 500), BYTE_BPE, size=16).collect()
    assert len(rows) == 500 and check_sequences(rows, 16) == 125
    assert packing.pack(frame(spark, []), BYTE_BPE).collect() == []


def test_chunks_encode_as_the_tokenizer_does_on_random_text():
    tokenizer, cache, rng = Tokenizer.from_file(BYTE_BPE), packing._ids(BYTE_BPE), random.Random(4)
    assert packing.byte_level_ranks(tokenizer) is not None
    alphabet = list("abcst'  \n\n\r\t.,!1²é世😀\x1c\xa0 \x85İ") + ["the", " th", "  ", "'ll", "<|endoftext|>"]
    for _ in range(20_000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14)))
        assert packing.token_ids(text, BYTE_BPE).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
