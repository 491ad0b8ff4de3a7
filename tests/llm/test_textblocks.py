"""Blocks of texts against plain Python, in one piece and in windows."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from afterglow.llm import ctph, quality, simhash
from afterglow.llm import substring_dedup as sd
from afterglow.llm import textblocks as tb

WORD = re.compile(rb"[^\x20\x09-\x0d]+")
RNG = random.Random(1)
TEXTS = [None, "", " ", "a", "é", "\n\n", *("".join(RNG.choice(["ab", "é", " ", "\n", "東", "\t", "x" * 70, "#"]) for _ in range(RNG.randint(0, 60))) for _ in range(80))]


@pytest.mark.parametrize(("block", "step"), [(1 << 21, 1 << 20), (64, 1 << 20), (64, 7), (1, 16)])
def test_words_lines_and_counts(monkeypatch, block, step):
    monkeypatch.setattr(tb, "STEP", step)
    found = [(b, i) for b in tb.blocks(pa.array(TEXTS), block) for i in range(b.n)]
    assert len(found) == len(TEXTS)
    for (b, i), text in zip(found, TEXTS, strict=True):
        data = (text or "").encode()
        words = slice(b.word_edges[i], b.word_edges[i + 1])
        starts, ends = (x[words] - b.edges[i] for x in b.words)
        assert [data[s:e] for s, e in zip(starts, ends, strict=True)] == WORD.findall(data)
        line_start, line_end, of = b.lines
        assert [data[s - b.edges[i] : e - b.edges[i]] for s, e, t in zip(line_start, line_end, of, strict=True) if t == i] == data.split(b"\n")
        assert b.count(tb.POINT)[i] == len(text or "") and b.count(tb.SYMBOL)[i] == data.count(b"#")


def test_hashes_tell_ranges_apart(monkeypatch):
    words = [bytes(RNG.choice(b"ab") for _ in range(RNG.randint(1, 90))) for _ in range(4000)]
    texts = [" ".join(w.decode() for w in words[i : i + 50]) for i in range(0, 4000, 50)]
    hashes = np.concatenate([b.word_hashes for b in tb.blocks(pa.array(texts))])
    assert len(set(zip(hashes.tolist(), words, strict=True))) == len(set(words)) == len(set(hashes.tolist()))
    monkeypatch.setattr(tb, "STEP", 13)
    assert (np.concatenate([b.word_hashes for b in tb.blocks(pa.array(texts), 100)]) == hashes).all()
    values = np.array([RNG.randrange(3) for _ in range(500)], np.uint64)
    for width in (1, 2, 3, 7, 8, 35):
        got = tb.rolled(values, width).tolist()
        runs = [tuple(values[i : i + width].tolist()) for i in range(500 - width + 1)]
        assert len(set(zip(got, runs, strict=True))) == len(set(runs)) == len(set(got))
    start = np.array([RNG.randrange(400) for _ in range(3000)])
    end = start + np.array([RNG.randrange(1, 90) for _ in range(3000)])
    got = tb.range_hashes(values, start, end).tolist()
    runs = [tuple(values[a:b].tolist()) for a, b in zip(start, end, strict=True)]
    assert len(set(zip(got, runs, strict=True))) == len(set(runs)) == len(set(got))


def test_windows_change_nothing(monkeypatch):
    """Small windows within a text give what whole texts give."""
    texts = [" ".join(RNG.choice(["the", "of", "é", "word", "x" * 30]) + RNG.choice(["", "\n"]) for _ in range(RNG.randint(0, 300))) for _ in range(20)]

    def everything(size):
        out = []
        for b in tb.blocks(pa.array(texts), size):
            base, ratios = quality.statistics(b)
            found = sd.segments(b, 9)
            out += [(*(int(v[i]) for v in base.values()), *ratios[i].tolist()) for i in range(b.n)]
            out += [tuple(x) for x in zip((found.first - b.word_edges[found.text]).tolist(), found.count.tolist(), found.anchor.tolist(), found.words.tolist(), strict=True)]
        per_text = [(ctph.signatures(np.frombuffer(t.encode(), np.uint8)), ctph.edited(t.encode(), texts[0].encode()), simhash.shingle_hashes(t.encode(), 5).tolist()) for t in texts]
        return sorted(map(str, out)), per_text

    whole = everything(1)
    for step in (64, 200, 1000):
        monkeypatch.setattr(tb, "STEP", step)
        assert everything(1) == whole
    for t, (_, (changed, n), _) in zip(texts, whole[1], strict=True):
        half = len(t) // 2
        assert n == len(t) and changed.decode() == t[: n - half] + texts[0][:half]
    assert b"".join(tb.windows_of(b"ab cd  efff", 3)) == b"ab cd  efff"
    parts = list(tb.windows_of(b"ab cd  efff g", 3))
    assert [w for p in parts for w in p.split()] == [b"ab", b"cd", b"efff", b"g"] and len(parts) > 2


def test_covered():
    for total in (0, 1, 5, 30):
        for width in (1, 3, 8):
            flags = np.array([RNG.random() < 0.2 for _ in range(max(total - width + 1, 0))], bool)
            want = [any(flags[j] for j in range(max(i - width + 1, 0), min(i + 1, len(flags)))) for i in range(total)]
            assert tb.covered(flags, width, total).tolist() == want
