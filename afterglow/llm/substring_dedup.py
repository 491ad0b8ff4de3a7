"""Substring dedup: remove word spans that occur elsewhere, found with suffix automata of reference shards.

Every window of `window` words has an anchor: the run of words with the smallest hash inside it. Equal windows have equal
anchors, so windows are compared only within the texts around one anchor. What lies around an anchor's occurrence, all
windows anchored there, is a segment. The different segments of an anchor are a reference shard: their suffix automaton,
weighted by how often each occurs, is streamed with the segments, and the matching statistics tell which windows occur
twice. Anchors seen once in the corpus are never looked at again.

The method as named broadcasts every shard to every document, which costs the square of the corpus. Here a document's
segments are routed to the shards they can match instead, and not all go through an automaton:

- where all segments of an anchor have one hash of all their words, each window occurs as often as the anchor does, which
  is what the automaton of a single segment would say; no text is fetched;
- an anchor with more than SHARD_SEGMENTS occurrences would make a shard of no fixed size, so its different segments are dealt
  to several shards, and their windows are counted by 128-bit digests: first within each shard, which settles all that occur
  twice there; then each shard's different windows are held against those of the anchor's other shards, one row each. That is
  exact, but no automaton.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from afterglow.llm import textblocks as tb
from afterglow.llm.spread import spread_join
from afterglow.session import materialise, ship_package

#: Segments of one anchor, repeated ones included, that a shard holds at most.
SHARD_SEGMENTS = 1_000
#: Windows that a segment can have; they are told apart by the bits of a long.
MAX_WINDOWS = 62


def anchor_width(window: int) -> int:
    return max(window // 4, window - MAX_WINDOWS + 1, 1)


class SuffixAutomaton:
    """Suffix automaton of several word sequences, each with a weight."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.weight = [0]

    def _state(self, length: int, link: int, moves: dict) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.weight.append(0)
        return len(self.next) - 1

    def _split(self, p: int, q: int, word) -> int:
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: Iterable, weight: int) -> None:
        """Add a sequence; its prefixes end `weight` more times."""
        last = 0
        for word in words:
            q = self.next[last].get(word)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, q, word)
            else:
                new = self._state(self.length[last] + 1, 0, {})
                p = last
                while p >= 0 and word not in self.next[p]:
                    self.next[p][word] = new
                    p = self.link[p]
                if p >= 0:
                    q = self.next[p][word]
                    self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word)
                last = new
            self.weight[last] += weight

    def close(self) -> None:
        """Pass weights on to suffixes: then a state's weight is how often its words occur."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.weight[self.link[state]] += self.weight[state]

    def occurrences(self, words: Iterable, size: int) -> Iterator[int]:
        """For each place of `words`, how often the `size` words ending there occur; 0 if the match is shorter."""
        state, matched = 0, 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state, matched = self.next[state][word], matched + 1
            if matched < size:
                yield 0
                continue
            at = state
            while self.length[self.link[at]] >= size:
                at = self.link[at]
            yield self.weight[at]


def repeated_windows(segments: list[tuple[list, int]], window: int) -> list[int]:
    """For each segment of a shard, with its number of occurrences, the mask of its windows that occur twice or more."""
    if len(segments) == 1:  # one chain: every state has its weight
        words, n = segments[0]
        return [(1 << (len(words) - window + 1)) - 1 if n > 1 else 0]
    automaton = SuffixAutomaton()
    for words, n in segments:
        automaton.add(words, n)
    automaton.close()
    masks = []
    for words, _ in segments:
        mask = 0
        for end, n in enumerate(automaton.occurrences(words, window)):
            if n > 1:
                mask |= 1 << (end - window + 1)
        masks.append(mask)
    return masks


def anchors(block: tb.Block, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window inside one text: its first word, its anchor's word, and the anchor's hash."""
    width, size = anchor_width(window), window - anchor_width(window) + 1
    text, hashes = block.word_text, block.word_hashes
    out: list[list[np.ndarray]] = [[np.zeros(0, block.kind)], [np.zeros(0, block.kind)], [np.zeros(0, np.uint64)]]
    for low in range(0, len(text) - window + 1, tb.STEP):
        high = min(low + tb.STEP, len(text) - window + 1)
        inside = np.flatnonzero(text[low:high] == text[low + window - 1 : high + window - 1])
        grams = tb.rolled(hashes[low : high + window - 1], width)
        best, at, have = grams, np.arange(len(grams), dtype=np.int32), 1
        while have < size:  # smallest of ever longer runs, the first of equals
            step = min(have, size - have)
            left, right = best[:-step], best[step:]
            later = right < left
            best, at = np.where(later, right, left), np.where(later, at[step:], at[:-step])
            have += step
        for part, found in zip(out, ((inside + low).astype(block.kind), (at[inside] + low).astype(block.kind), best[inside]), strict=True):
            part.append(found)
    return tuple(np.concatenate(part) for part in out)


@dataclass
class Segments:
    """Runs of windows with one anchor: first word, number of windows, the anchor's hash, a hash of all words, and the text."""

    first: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    words: np.ndarray
    text: np.ndarray


def segments(block: tb.Block, window: int) -> Segments:
    starts, at, grams = anchors(block, window)
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)])) if len(starts) else np.zeros(0, np.int64)
    first, count = starts[new].astype(np.int64), np.diff(np.append(new, len(starts)))
    return Segments(first, count, grams[new], tb.range_hashes(block.word_hashes, first, first + count + window - 1), block.word_text[first].astype(np.int64))


#: A row, by 128 bits of its doc_id and text.
KEY = "__key"


def without_repeats(docs: DataFrame, window: int = 35, text: str = "text") -> DataFrame:
    """All rows and columns of `docs`, plus `kept_text`, `n_words` and `n_removed`.

    Words are runs outside [\\x20\\x09-\\x0D], compared unchanged. A word goes if a window of `window` words that covers it
    also starts anywhere else in the corpus, the same document included; windows are judged on the input. The words that
    stay are joined by one space.

    A null text has no words. Each row is a document: rows that are wholly equal repeat each other. A null doc_id is a key
    like any other; an empty table gives an empty result. Columns of the same name as a new one are replaced, all others
    pass through, whatever their names.
    """
    spark = docs.sparkSession
    ship_package(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = [c for c in docs.columns if c not in ("kept_text", "n_words", "n_removed")]
    key = F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce(F.col(text), F.lit("")))))
    keyed = docs.select(key.alias(KEY), F.col(text).alias("__text"), F.struct(*named).alias("__row"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tb.blocks(batch.column(1)):
                found = segments(block, window)
                place = (found.first - block.word_edges[found.text]) << 8 | found.count
                at = pa.array(found.text + block.rows[0])
                columns = [batch.column(0).take(at), pa.array(place), pa.array(found.anchor.view(np.int64)), pa.array(found.words.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=[KEY, "place", "anchor", "words"])

    each = keyed.select(KEY, "__text").mapInArrow(find, f"{KEY} binary, place long, anchor long, words long")
    # anchors seen twice, and whether what lies around them is always the same
    seen = each.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("words").alias("least"), F.max("words").alias("most")).filter("n > 1")
    shards = F.ceil(F.col("n") / SHARD_SEGMENTS).cast("int").alias("shards")
    known = materialise(seen.select("anchor", "n", (F.col("least") == F.col("most")).alias("equal"), shards))
    hits = materialise(spread_join(each, known, "anchor", by=F.xxhash64(KEY, "place")))
    alike = hits.filter("equal").select(KEY, F.shiftright("place", 8).alias("start"), (F.expr("shiftleft(1L, cast(place & 255 as int))") - 1).alias("mask"))
    unlike = hits.filter("NOT equal")

    # the documents dealt by key once: for the texts of unlike segments, and for the removal
    dealt = keyed.repartition(n, KEY)
    wanted = unlike.groupBy(KEY).agg(F.collect_set(F.struct("anchor", "shards")).alias("wanted"))
    texts = dealt.select(KEY, "__text").join(wanted, KEY)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tb.blocks(batch.column(0)):
                lists = batch.column(1).slice(block.rows[0], block.n)
                edges = lists.offsets.to_numpy()
                inner = lists.values.slice(edges[0], edges[-1] - edges[0])
                shards = {(t, a): c for t, a, c in zip(np.repeat(np.arange(block.n), np.diff(edges)).tolist(), inner.field(0).to_pylist(), inner.field(1).to_pylist(), strict=True)}
                found = segments(block, window)
                starts, ends = block.words
                data = memoryview(block.data)
                out: list[list] = [[], [], [], []]
                for t, anchor, words, a, size in zip(found.text.tolist(), found.anchor.view(np.int64).tolist(), found.words.view(np.int64).tolist(), found.first.tolist(), found.count.tolist(), strict=True):
                    dealt_to = shards.get((t, anchor))
                    if dealt_to is not None:
                        piece = b" ".join(bytes(data[starts[a] : ends[a + size + window - 2]]).split())
                        for column, v in zip(out, (anchor, words, piece, dealt_to), strict=True):
                            column.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.binary(), pa.int32()), strict=True)], names=["anchor", "words", "piece", "shards"])

    pieces = texts.select("__text", "wanted").mapInArrow(cut, "anchor long, words long, piece binary, shards int").groupBy("anchor", "words", "piece", "shards").agg(F.count(F.lit(1)).alias("n"))
    judged = materialise(_judged(pieces, window))
    # a window has at most one row from each shard of its anchor
    across = judged.filter("window IS NOT NULL").withColumn("times", F.sum("n").over(Window.partitionBy("window"))).filter("times > 1 AND anchor IS NOT NULL")
    masks = judged.filter("window IS NULL").unionAll(across.drop("times")).groupBy("anchor", "words").agg(F.bit_or("mask").alias("mask"))
    # a segment is named by its anchor and words together, so copies of one passage are the hot names here
    times = unlike.groupBy("anchor", "words").agg(F.count(F.lit(1)).alias("n"))
    name = F.struct("anchor", "words").alias("name")
    marked = materialise(times.join(masks, ["anchor", "words"]).select(name, "mask", "n"))
    partly = spread_join(unlike.select(KEY, "place", name), marked, "name", by=F.xxhash64(KEY, "place")).select(KEY, F.shiftright("place", 8).alias("start"), "mask")
    gone = alike.unionAll(partly).groupBy(KEY).agg(F.collect_set(F.struct("start", "mask")).alias("__gone"))
    out = dealt.join(gone, KEY, "left").select("__text", "__gone", "__row")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, removed = [pa.array([], pa.large_string())], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for block in tb.blocks(batch.column(0)):
                drop = covered_words(block, batch.column(1).slice(block.rows[0], block.n), window)
                counts.append(np.diff(block.word_edges).astype(np.int64))
                removed.append(np.bincount(block.word_text[drop], minlength=block.n).astype(np.int64))
                texts.append(kept_texts(block, ~drop))
            kept = pa.concat_arrays(texts)
            row = batch.column(2)
            extra = [kept.cast(pa.string()) if kept.nbytes < 1 << 31 else kept, pa.array(np.concatenate(counts)), pa.array(np.concatenate(removed))]
            yield pa.RecordBatch.from_arrays([*row.flatten(), *extra], names=[*named, "kept_text", "n_words", "n_removed"])

    schema = docs.select(*named).schema
    for name, kind in (("kept_text", "string"), ("n_words", "long"), ("n_removed", "long")):
        schema = schema.add(name, kind)
    return out.mapInArrow(remove, schema)


def covered_words(block: tb.Block, spans: pa.ListArray, window: int) -> np.ndarray:
    """Words of a block covered by the repeated windows of each text: lists of (first word, mask of windows from there)."""
    total = len(block.word_text)
    flags = np.zeros(total, bool)
    sizes = spans.value_lengths().fill_null(0).to_numpy()
    inner = spans.flatten()
    if len(inner):
        start = inner.field(0).to_numpy() + np.repeat(block.word_edges[:-1], sizes)
        mask = inner.field(1).to_numpy()
        for bit in range(MAX_WINDOWS):
            flags[start[mask >> bit & 1 == 1] + bit] = True
    return tb.covered(flags, window, total)


def kept_texts(block: tb.Block, keep: np.ndarray) -> pa.LargeStringArray:
    """The kept words of each text of a block, joined by one space."""
    starts, ends = (places[keep] for places in block.words)
    edges = np.searchsorted(starts, block.edges.astype(block.kind))
    last = np.zeros(len(starts), bool)
    last[edges[1:][edges[1:] > edges[:-1]] - 1] = True
    sizes = (ends - starts).astype(np.int64) + ~last  # a space follows each word but a text's last
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    change = np.zeros(len(block.data) + 1, np.int8)
    change[starts] = 1
    change[ends[last]] -= 1
    after = ends[~last] + 1  # white space that becomes the space between
    change[after] -= 1
    data = block.data.copy()
    data[after - 1] = 0x20
    np.cumsum(change, out=change)
    kept = data[change[:-1].view(bool)]
    return pa.LargeStringArray.from_buffers(block.n, pa.py_buffer(offsets[edges].astype(np.int64)), pa.py_buffer(kept))


def _judged(pieces: DataFrame, window: int) -> DataFrame:
    """(anchor, words, mask) of segments with repeated windows, from their shards.

    The rows of a shard lie together in one partition: an anchor's, or those dealt there of an anchor with several shards. Those
    also give each of their different windows, to be held against the other shards: a digest of it, how often it occurs here, and
    the segment with its bit in `mask` if it occurs once, else no segment, as it is settled.
    """
    columns = ["anchor", "words", "mask", "window", "n"]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple[int, bytes, int]] = []
        of: tuple = (None, None, None)  # anchor, its shards, which of them
        for batch in batches:
            out: list[tuple] = []
            for anchor, words, piece, shards, part, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (anchor, shards, part) != of:
                    out += _judge(of, shard, window)
                    shard, of = [], (anchor, shards, part)
                shard.append((words, piece, n))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 5, kinds, strict=True)], names=columns)
        out = _judge(of, shard, window)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 5, kinds, strict=True)], names=columns)

    n = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("piece"), F.col("shards")).cast("int")
    dealt = pieces.withColumn("part", part).repartition(n, "anchor", "part").sortWithinPartitions("anchor", "part", "piece")
    return dealt.select("anchor", "words", "piece", "shards", "part", "n").mapInArrow(run, "anchor long, words long, mask long, window binary, n long")


def _judge(of: tuple, shard: list[tuple[int, bytes, int]], window: int) -> list[tuple]:
    if not shard:
        return []
    anchor, shards, _ = of
    split = [piece.split(b" ") for _, piece, _ in shard]
    if shards == 1:
        masks = repeated_windows([(parts, n) for parts, (_, _, n) in zip(split, shard, strict=True)], window)
        return [(anchor, words, mask, None, n) for (words, _, n), mask in zip(shard, masks, strict=True) if mask]
    digests = [[hashlib.md5(b" ".join(parts[i : i + window])).digest() for i in range(len(parts) - window + 1)] for parts in split]
    times: Counter[bytes] = Counter()
    for found, (_, _, n) in zip(digests, shard, strict=True):
        for digest in found:
            times[digest] += n
    out: list[tuple] = [(None, None, None, digest, n) for digest, n in times.items() if n > 1]
    for found, (words, _, n) in zip(digests, shard, strict=True):
        mask = 0
        for i, digest in enumerate(found):
            if times[digest] > 1:
                mask |= 1 << i
            else:
                out.append((anchor, words, 1 << i, digest, 1))
        if mask:
            out.append((anchor, words, mask, None, n))
    return out
