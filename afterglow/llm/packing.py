"""Best-fit packing of token sequences by pattern counts fitted with non-negative least squares."""

from __future__ import annotations

import array
import bisect
import json
import re
import sys
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from afterglow.llm.rows import texts_of
from afterglow.session import materialise, ship_package

#: Distinct chunks of text whose ids a worker keeps; beyond it the cache starts anew.
CACHE_ENTRIES = 400_000
#: Longer chunks are not kept.
CACHED_CHARS = 200
#: A piece of text that byte-level pre-tokenisation never joins with its neighbours: white space and what follows.
CHUNK = re.compile(r"[ \n\r\t]*[^ \n\r\t]+|[ \n\r\t]+")
#: White space other than those four could join across such chunks; such texts are encoded whole.
OTHER_SPACE = re.compile(r"[\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")
#: Fixed value: the pattern of byte-level pre-tokenisation.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Salts, at least, that spread the documents of one length for ranking; as many as shuffle partitions if those are more.
SALTS = 64
#: Patterns of up to this many documents are enumerated.
PATTERN_PARTS = 3
#: Enumerated patterns of three documents for each length; bounds the least-squares problem.
TRIPLES_PER_LENGTH = 4


def little_endian(ids: list[int]) -> bytes:
    data = array.array("I", ids)
    if sys.byteorder == "big":
        data.byteswap()
    return data.tobytes()


def byte_level_ranks(tokenizer) -> dict[bytes, int] | None:
    """Bytes of each token of a byte-level BPE → its id, if ids are in the order of merging; else None.

    Printable characters of Latin-1 stand for their own byte, the others for 256 and up in order of their bytes.
    """
    model = json.loads(tokenizer.to_str())
    pre = model["pre_tokenizer"] or {}
    if model["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex"):
        return None
    printable = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174}
    hidden = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}
    added = {t["content"] for t in model["added_tokens"]}
    vocabulary = {t: i for t, i in model["model"]["vocab"].items() if t not in added}
    merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in model["model"]["merges"]]
    if merged != sorted(merged) or len(vocabulary) != len(merged) + 256:
        return None
    return {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items()}


class _Ids(dict):
    """Chunk of text → its ids as unsigned little-endian 32-bit numbers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.added = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.encode = lambda chunk: self.tokenizer.encode(chunk, add_special_tokens=False).ids
        if ranks := byte_level_ranks(self.tokenizer):  # the same merges, with less work for a short chunk
            import tiktoken

            self.encode = tiktoken.Encoding("chunks", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __missing__(self, chunk: str) -> bytes:
        found = little_endian(self.encode(chunk))
        if len(chunk) <= CACHED_CHARS:
            self[chunk] = found
        return found

    def of(self, text: str) -> bytes:
        if OTHER_SPACE.search(text) or any(token in text for token in self.added):
            return little_endian(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if len(self) > CACHE_ENTRIES:
            self.clear()
        return b"".join([self[chunk] for chunk in CHUNK.findall(text)])


@lru_cache(maxsize=2)
def _ids(path: str) -> _Ids:
    return _Ids(path)


def token_ids(text: str, tokenizer_path: str) -> np.ndarray:
    """Ids of a text without added special tokens."""
    return np.frombuffer(_ids(tokenizer_path).of(text), "<u4")


def pieces_of(docs: DataFrame, tokenizer_path: str, size: int, end_id: int, text: str, with_ids: bool) -> DataFrame:
    """Documents cut into pieces: doc_id, row_hash, piece, start, length, ids_crc32 and with `with_ids` the ids."""
    ship_package(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, end = _ids(tokenizer_path), little_endian([end_id])
        for batch in batches:
            source, piece, start, length, crc, ids = [], [], [], [], [], []
            for row, value in enumerate(texts_of(batch.column(1))):
                data = cache.of(value) + end
                total = len(data) // 4
                first = total % size or size
                edges = [0, *range(first, total + 1, size)]
                for n, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    source.append(row)
                    piece.append(n)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(data[4 * a : 4 * b]))
                    if with_ids:
                        ids.append(np.frombuffer(data[4 * a : 4 * b], "<u4").astype(np.int32))
            columns = [batch.column(0).take(pa.array(source, pa.int64())), batch.column(2).take(pa.array(source, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "row_hash", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("row_hash", T.LongType()), T.StructField("piece", T.IntegerType()), *(T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32"))])
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    return docs.select("doc_id", F.col(text), F.xxhash64("doc_id", text).alias("row_hash")).mapInArrow(run, schema)


def non_negative_least_squares(columns: list[np.ndarray], weights: list[np.ndarray], target: np.ndarray, sweeps: int = 200) -> np.ndarray:
    """x >= 0 that minimises |Ax - target|, by coordinate descent; a column of A is (row numbers, values)."""
    x, rest = np.zeros(len(columns)), target.astype(float).copy()
    norms = [float(w @ w) for w in weights]
    for _ in range(sweeps):
        moved = 0.0
        for j, (rows, w) in enumerate(zip(columns, weights, strict=True)):
            step = max(-x[j], float(w @ rest[rows]) / norms[j])
            if step:
                x[j] += step
                rest[rows] -= step * w
                moved = max(moved, abs(step))
        if moved < 0.05:
            break
    return x


def length_patterns(counts: np.ndarray, size: int) -> list[tuple[int, ...]]:
    """Patterns of up to three present lengths that fill a sequence, or nearly so."""
    present = np.flatnonzero(counts)
    present = present[present > 0]
    have = set(present.tolist())
    found: set[tuple[int, ...]] = set()

    def fitting(room: int) -> int:
        """The largest present length that fits, 0 if none does."""
        i = int(np.searchsorted(present, room, side="right"))
        return int(present[i - 1]) if i else 0

    for a in have:
        if a == size:
            found.add((a,))
            continue
        b = fitting(size - a)
        if not b:
            found.add((a,))
            continue
        found.add(tuple(sorted((a, b), reverse=True)))
        # third parts: seconds spread over the present lengths that leave room
        seconds = present[: int(np.searchsorted(present, size - a - int(present[0]), side="right"))]
        if len(seconds):
            for i in np.unique(np.linspace(0, len(seconds) - 1, TRIPLES_PER_LENGTH).astype(int)):
                second = int(seconds[i])
                third = fitting(size - a - second)
                if third:
                    found.add(tuple(sorted((a, second, third), reverse=True)))
    return sorted(found, reverse=True)


def best_fit(counts: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over a histogram: (pattern, how many sequences of it), in groups of equal sequences."""
    room: dict[int, list[list]] = defaultdict(list)  # space left → groups [pattern, count]
    spaces: list[int] = []
    done: list[tuple[tuple[int, ...], int]] = []
    def put(pattern: tuple[int, ...], count: int, left: int) -> None:
        if left == 0:
            done.append((pattern, count))
            return
        if not room[left]:
            bisect.insort(spaces, left)
        room[left].append([pattern, count])

    for length in range(len(counts) - 1, 0, -1):
        todo = int(counts[length])
        while todo:
            i = bisect.bisect_left(spaces, length)
            if i == len(spaces):
                each = size // length
                if todo >= each:
                    put((length,) * each, todo // each, size - each * length)
                if todo % each:
                    put((length,) * (todo % each), 1, size - (todo % each) * length)
                todo = 0
                continue
            left = spaces[i]
            group = room[left][-1]
            used = min(group[1], todo)
            group[1] -= used
            if not group[1]:
                room[left].pop()
                if not room[left]:
                    spaces.pop(i)
            put((*group[0], length), used, left - length)
            todo -= used
    return done + [(pattern, count) for groups in room.values() for pattern, count in groups]


def plan_sequences(counts: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """(pattern of lengths, number of sequences) covering a histogram `counts[length]` exactly.

    Repeat counts of enumerated patterns are fitted to the histogram by non-negative least squares and rounded down,
    never beyond what is left of a length; what remains is packed by best-fit decreasing, in groups of equal
    sequences. Work and memory depend on the number of lengths, not of documents.
    """
    left = counts.astype(np.int64).copy()
    plan: list[tuple[tuple[int, ...], int]] = []
    patterns = length_patterns(left, size)
    parts = [np.unique(p, return_counts=True) for p in patterns]
    fitted = non_negative_least_squares([p[0] for p in parts], [p[1].astype(float) for p in parts], left)
    for j in sorted(range(len(patterns)), key=lambda j: (sum(patterns[j]) != size, -fitted[j])):
        if size - sum(patterns[j]) > size // 256:
            continue  # nearly full patterns only; the rest packs better
        times = min(int(fitted[j]), *(int(left[v] // n) for v, n in zip(*parts[j], strict=True)))
        if times > 0:
            plan.append((patterns[j], times))
            for v, n in zip(*parts[j], strict=True):
                left[v] -= n * times
    return plan + best_fit(left, size)


def slots(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first rank, first sequence and offset of each run of equal places, in order of rank."""
    runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    ranks: dict[int, int] = defaultdict(int)
    sequence = 0
    for pattern, count in plan:
        offset = 0
        for length in pattern:
            runs[length].append((ranks[length], sequence, offset))
            ranks[length] += count
            offset += length
        sequence += count
    return {length: tuple(np.array(column, np.int64) for column in zip(*found, strict=True)) for length, found in runs.items()}


def pack(docs: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 0, text: str = "text", with_ids: bool = False) -> DataFrame:
    """Pack all documents into sequences of at most `size` tokens: one row for each piece with doc_id, piece, start,
    length, ids_crc32, sequence_id and offset, and with `with_ids` its ids.

    A document is its ids and `end_id`. Only documents longer than `size` are cut, into pieces of `size` of which the
    first may be shorter. The driver sees a histogram of at most `size` lengths and plans patterns from it; a piece takes
    the place of its rank among the pieces of its length. Ranks come from counts by (length, salt) and a rank within each
    salt, so no length gathers in one task.

    A null text is empty and takes one token. Repeated rows and null doc_ids are documents of their own; an empty table
    gives no rows. Other columns of `docs` are not read.
    """
    spark = docs.sparkSession
    salts = max(SALTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pieces = materialise(pieces_of(docs, tokenizer_path, size, end_id, text, with_ids).withColumn("salt", F.pmod(F.xxhash64("row_hash", "piece", "ids_crc32"), F.lit(salts)).cast("int")))
    by_salt = materialise(pieces.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")))
    histogram = np.zeros(size + 1, np.int64)
    for row in by_salt.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `size` rows
        histogram[row["length"]] = row["n"]
    places = spark.sparkContext.broadcast(slots(plan_sequences(histogram, size)))
    earlier = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)  # at most one row a salt
    ahead = by_salt.select("length", "salt", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "salt").orderBy("row_hash", "piece", "ids_crc32")
    ranked = pieces.withColumn("rank", F.row_number().over(within) - 1).join(ahead, ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("before"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, rank):
        import pandas as pd

        lengths, ranks = length.to_numpy(), rank.to_numpy()
        out = np.empty((2, len(lengths)), np.int64)
        order = np.argsort(lengths, kind="stable")
        edges = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
        for a, b in zip(edges, edges[1:], strict=False):
            rows = order[a:b]
            first, sequence, offset = places.value[int(lengths[rows[0]])]
            run = np.searchsorted(first, ranks[rows], side="right") - 1
            out[0, rows] = sequence[run] + ranks[rows] - first[run]
            out[1, rows] = offset[run]
        return pd.DataFrame({"sequence_id": out[0], "offset": out[1]})

    kept = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    return ranked.withColumn("place", place("length", "rank")).select(*kept, "place.sequence_id", "place.offset")
