"""Words and lines of many texts at once, as numpy arrays over their UTF-8 bytes.

A block is a few megabytes of whole texts, or one longer text. Words are runs of bytes outside [\\x20\\x09-\\x0D]. Words and
lines are hashed eight bytes at a time, each step mixed with the one before, and long ones by XXH64; runs of words are
hashed from pairs of runs half as long, mixed again at each step. No such hash is a sum, so swapped parts do not cancel.
Byte-sized work goes through a text in windows, so that a very long text costs little more than its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash

#: A block takes whole texts up to about so many bytes; a longer text is a block of its own.
BLOCK_BYTES = 2 << 20
#: Bytes, words or hashes that are worked on at once within a block.
STEP = 1 << 20
#: Longer ranges of bytes are hashed by XXH64.
CHAINED_BYTES = 64
_ODD = np.uint64(0x9E3779B97F4A7C15)
_CHUNK_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


def byte_set(members: bytes) -> np.ndarray:
    """A table of 256 flags, set for the members."""
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


SPACE = byte_set(b" \t\n\x0b\x0c\r")
SYMBOL = byte_set(b"#*$%&|<>")
#: Bytes that begin a code point, and those of them outside white space.
POINT = (np.arange(256) & 0xC0) != 0x80
WORD_POINT = POINT & ~SPACE


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of two runs side by side."""
    return mixed(left * _ODD ^ right)


def rolled(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of `width` values: len(values) - width + 1 of them."""
    count = len(values) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    found, at, level, size = None, 0, values, 1
    while True:
        if width & size:
            part = level[at : at + count]
            found, at = part if found is None else joined(found, part), at + size
        size *= 2
        if size > width:
            return found
        level = joined(level[: -(size // 2)], level[size // 2 :])


def range_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each range of values."""
    length = end - start
    found, at, level, size = mixed(length.astype(np.uint64) + _ODD), start.copy(), values, 1
    longest = int(length.max(initial=0))
    while size <= longest:
        some = np.flatnonzero(length & size)
        found[some] = joined(found[some], level[at[some]])
        at[some] += size
        size *= 2
        if size <= longest:
            level = joined(level[: -(size // 2)], level[size // 2 :])
    return found


def byte_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges. Ranges of one length up to eight bytes never collide."""
    out = np.empty(len(start), np.uint64)
    for at in range(0, len(start), STEP):
        out[at : at + STEP] = _byte_hashes(data, start[at : at + STEP], end[at : at + STEP])
    return out


def _byte_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    if not len(start):
        return np.zeros(0, np.uint64)
    base = int(start[0])
    near = np.zeros(int(end.max()) - base + 8, np.uint8)
    near[:-8] = data[base : base + len(near) - 8]
    eight = np.ndarray((len(near) - 7,), "<u8", near, strides=(1,))  # the eight bytes from each place on
    first, size = start - base, end - start
    h = mixed(size.astype(np.uint64) + _ODD)
    h = mixed(h ^ (eight[first] & _CHUNK_MASKS[np.minimum(size, 8)])) + _ODD
    done, rest = 8, np.flatnonzero((size > 8) & (size <= CHAINED_BYTES))
    while len(rest):
        h[rest] = mixed(h[rest] ^ (eight[first[rest] + done] & _CHUNK_MASKS[np.minimum(size[rest] - done, 8)])) + _ODD
        done += 8
        rest = rest[size[rest] > done]
    view = memoryview(near)
    for i in np.flatnonzero(size > CHAINED_BYTES).tolist():
        a = int(first[i])
        h[i] = xxhash.xxh64_intdigest(view[a : a + int(size[i])])
    return h


@dataclass
class Block:
    rows: np.ndarray  #: places of the texts in their batch
    data: np.ndarray  #: all bytes
    edges: np.ndarray  #: where each text begins, and the end

    @property
    def n(self) -> int:
        return len(self.rows)

    @property
    def kind(self) -> type:
        """The integers that places in the data are told by."""
        return np.int32 if len(self.data) < 1 << 31 else np.int64

    def count(self, table: np.ndarray) -> np.ndarray:
        """How many bytes of each text are in a table of 256 flags."""
        if self.n == 1:
            return np.array([sum(int(np.count_nonzero(table[self.data[at : at + STEP]])) for at in range(0, len(self.data), STEP))])
        sums = np.zeros(len(self.data) + 1, self.kind)
        np.cumsum(table[self.data], out=sums[1:])
        return np.diff(sums[self.edges]).astype(np.int64)

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Where words start and end."""
        total = len(self.data)
        starts, ends = [], []
        for low in range(0, total, STEP):
            high = min(low + STEP, total)
            inside = np.zeros(high - low + 2, bool)  # with the byte before and the byte after
            a, b = max(low - 1, 0), min(high + 1, total)
            inside[a - low + 1 : b - low + 1] = ~SPACE[self.data[a:b]]
            border = np.zeros(high - low + 1, bool)
            border[self.edges[np.searchsorted(self.edges, low) : np.searchsorted(self.edges, high, side="right")] - low] = True
            starts.append((np.flatnonzero(inside[1:-1] & (~inside[:-2] | border[:-1])) + low).astype(self.kind))
            ends.append((np.flatnonzero(inside[1:-1] & (~inside[2:] | border[1:])) + low + 1).astype(self.kind))
        none = np.zeros(0, self.kind)
        return np.concatenate([none, *starts]), np.concatenate([none, *ends])

    @cached_property
    def word_edges(self) -> np.ndarray:
        """Where each text's words begin in the list of words, and the end."""
        return np.searchsorted(self.words[0], self.edges.astype(self.kind), side="left")

    @cached_property
    def word_text(self) -> np.ndarray:
        """The text of each word, counted in the block."""
        return np.repeat(np.arange(self.n, dtype=np.int32), np.diff(self.word_edges))

    @cached_property
    def word_hashes(self) -> np.ndarray:
        return byte_hashes(self.data, *self.words)

    @cached_property
    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text of each line; a text has one more line than line feeds."""
        feeds = np.concatenate([np.zeros(0, self.kind), *((np.flatnonzero(self.data[at : at + STEP] == 10) + at).astype(self.kind) for at in range(0, len(self.data), STEP))])
        if self.n == 1:
            return np.concatenate([[0], feeds + 1]).astype(self.kind), np.append(feeds, len(self.data)).astype(self.kind), np.zeros(len(feeds) + 1, np.int32)
        text = np.searchsorted(self.edges, feeds, side="right") - 1
        # a feed belongs to the last text that starts at or before it, which is never empty
        starts = np.concatenate([self.edges[:-1], feeds + 1])
        ends = np.concatenate([feeds, self.edges[1:]])
        of_start = np.concatenate([np.arange(self.n), text])
        of_end = np.concatenate([text, np.arange(self.n)])
        order, back = np.lexsort((starts, of_start)), np.lexsort((ends, of_end))
        return starts[order], ends[back], of_start[order]


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks that cover all texts of a column in order; nulls are empty."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    buffer = column.buffers()[2] if len(column) else None
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1)
        last = min(last, len(column))
        yield Block(np.arange(first, last), data[offsets[first] : offsets[last]], (offsets[first : last + 1] - offsets[first]).astype(np.int64))
        first = last


def windows_of(data: bytes, size: int = STEP) -> Iterator[bytes]:
    """A text in parts of about `size` bytes that end before white space, so that no word is cut; a longer word stays whole."""
    at = 0
    while at < len(data):
        end = at + size
        while end < len(data):
            space = np.flatnonzero(SPACE[np.frombuffer(data, np.uint8, min(STEP, len(data) - end), end)])
            if len(space):
                end += int(space[0])
                break
            end += STEP
        yield data[at:end]
        at = end


def run_lengths(text: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The text of each different (text, hash), and how often it occurs there."""
    if n == 1:
        h = np.sort(hashes)
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
        return np.zeros(len(first), np.int64), np.diff(np.append(first, len(h)))
    order = np.lexsort((hashes, text))
    t, h = text[order], hashes[order]
    first = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (h[1:] != h[:-1])])) if len(t) else np.zeros(0, np.int64)
    return t[first], np.diff(np.append(first, len(t)))


def repeated_in_text(text: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Flags hashes that their text holds twice or more."""
    if n == 1:
        h = np.sort(hashes)
        twice = np.unique(h[1:][h[1:] == h[:-1]])
        out = np.zeros(len(hashes), bool)
        for at in range(0, len(hashes) if len(twice) else 0, STEP):
            part = hashes[at : at + STEP]
            out[at : at + STEP] = twice[np.minimum(np.searchsorted(twice, part), len(twice) - 1)] == part
        return out
    order = np.lexsort((hashes, text))
    t, h = text[order], hashes[order]
    same = (t[1:] == t[:-1]) & (h[1:] == h[:-1])
    flags = np.zeros(len(t), bool)
    flags[1:] |= same
    flags[:-1] |= same
    out = np.zeros(len(t), bool)
    out[order] = flags
    return out


def covered(flags: np.ndarray, width: int, total: int) -> np.ndarray:
    """Places covered by windows of `width` that start where flagged; `total` places in all."""
    sums = np.zeros(total + 1, np.int32)
    np.cumsum(flags[:total], out=sums[1 : len(flags[:total]) + 1])
    sums[len(flags[:total]) + 1 :] = sums[len(flags[:total])]
    out = sums[1:] > 0
    if total > width:
        out[width:] = sums[width + 1 :] > sums[1 : total - width + 1]
    return out
