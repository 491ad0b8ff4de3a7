"""Document fingerprints by context-triggered piecewise hashing, compared by edit distance."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from afterglow.llm import textblocks as tb
from afterglow.llm.rows import raw_texts
from afterglow.session import ship_package

ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
#: Bytes that the rolling hash sees.
CONTEXT = 7
#: A signature has at most so many chunks, so that its comparison fits into one machine word.
SIGNATURE = 64
SMALLEST = 2  #: blocks of 2^SMALLEST bytes at least
#: Random numbers for the rolling hash: one for each byte value, and an odd one for each place.
VALUES, WEIGHTS = (np.random.default_rng(20240917 + i).integers(0, 1 << 63, size, np.uint64) << np.uint64(1) | np.uint64(1) for i, size in enumerate((256, CONTEXT)))


def triggers(data: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """The block size as a power of two, where chunks end at that size, and which of these ends hold at twice that.

    The text is read in windows; whenever as many ends as a signature has letters are at hand, the size doubles, so no more are held.
    """
    n, size = len(data), SMALLEST
    chosen, seen = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    for low in range(0, n, tb.STEP):
        high = min(low + tb.STEP, n)
        first = max(low - CONTEXT + 1, 0)
        values = VALUES[data[first:high]]
        rolling = values.copy()
        for back in range(1, min(CONTEXT, len(values))):
            rolling[back:] += values[:-back] * WEIGHTS[back]
        rolling = tb.mixed(rolling[low - first :])
        here = np.flatnonzero(rolling & np.uint64((1 << size) - 1) == 0)
        chosen, seen = np.concatenate([chosen, here + low]), np.concatenate([seen, rolling[here]])
        while len(chosen) >= SIGNATURE:
            size += 1
            keep = seen & np.uint64((1 << size) - 1) == 0
            chosen, seen = chosen[keep], seen[keep]
    return size, chosen, seen & np.uint64((2 << size) - 1) == 0


def signatures(data: np.ndarray) -> tuple[int, bytes, bytes]:
    """Block size as a power of two, and the signatures at that size and at twice that.

    A chunk ends where the rolling hash of the last seven bytes has as many trailing zeros as the block size asks for, so
    an edit moves only the borders near it. The block size is the smallest at which at most 64 chunks arise. A chunk is
    hashed as a whole to one of 64 letters.
    """
    n = len(data)
    if not n:
        return SMALLEST, b"", b""
    size, chosen, coarse = triggers(data)
    view = memoryview(data)

    def letters(borders: np.ndarray) -> bytes:
        edges = [0, *(borders + 1).tolist()]
        if edges[-1] != n:
            edges.append(n)
        return bytes([ALPHABET[xxhash.xxh64_intdigest(view[a:b]) >> 58] for a, b in zip(edges, edges[1:], strict=False)])

    return size, letters(chosen), letters(chosen[coarse])


def written(found: tuple[int, bytes, bytes]) -> str:
    return f"{1 << found[0]}:{found[1].decode()}:{found[2].decode()}"


def read(fingerprint: str) -> tuple[int, bytes, bytes]:
    size, fine, coarse = fingerprint.split(":")
    return int(size).bit_length() - 1, fine.encode(), coarse.encode()


def edit_distances(pairs: list[tuple[bytes, bytes]]) -> np.ndarray:
    """Levenshtein distances of strings of at most 64 letters, bit-parallel, all pairs side by side."""
    count = len(pairs)
    if not count:
        return np.zeros(0, np.int64)
    rows = max(max((len(b) for _, b in pairs), default=0), 1)
    size_a = np.array([len(a) for a, _ in pairs])
    size_b = np.array([len(b) for _, b in pairs])
    text = np.zeros((count, rows), np.uint8)
    masks = np.zeros((count, 256), np.uint64)
    for i, (a, b) in enumerate(pairs):
        text[i, : len(b)] = np.frombuffer(b, np.uint8)
    flat = np.frombuffer(b"".join(a for a, _ in pairs), np.uint8)
    of = np.repeat(np.arange(count), size_a)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(size_a) - size_a, size_a)
    np.bitwise_or.at(masks, (of, flat), np.uint64(1) << place.astype(np.uint64))
    full = np.uint64((1 << 64) - 1)
    one = np.uint64(1)
    plus, minus, score, every = np.full(count, full), np.zeros(count, np.uint64), size_a.copy(), np.arange(count)
    top = (np.maximum(size_a, 1) - 1).astype(np.uint64)
    for j in range(rows):
        live = (j < size_b) & (size_a > 0)
        eq = masks[every, text[:, j]]
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        up, down = minus | ~(xh | plus), plus & xh
        score += np.where(live, (up >> top & one).astype(np.int64) - (down >> top & one).astype(np.int64), 0)
        up = (up << one) | one
        down = down << one
        plus, minus = down | ~(xv | up), up & xv
    return np.where(size_a == 0, size_b, score)


def likeness(pairs: list[tuple[tuple[int, bytes, bytes], tuple[int, bytes, bytes]]]) -> np.ndarray:
    """1 less the edit distance as a share of the longer signature, at the best block size both have; 0 if they have none."""
    asked, owner = [], []
    for i, (x, y) in enumerate(pairs):
        for a, b in {(x[1], y[1])} if x[0] == y[0] else {(x[2], y[1])} if x[0] + 1 == y[0] else {(x[1], y[2])} if x[0] == y[0] + 1 else set():
            asked.append((a, b))
            owner.append(i)
        if x[0] == y[0]:
            asked.append((x[2], y[2]))
            owner.append(i)
    out = np.zeros(len(pairs))
    if asked:
        longest = np.array([max(len(a), len(b), 1) for a, b in asked])
        np.maximum.at(out, owner, 1 - edit_distances(asked) / longest)
    return out


def code_points(text: bytes) -> int:
    data = np.frombuffer(text, np.uint8)
    return sum(int(np.count_nonzero(tb.POINT[data[at : at + tb.STEP]])) for at in range(0, len(data), tb.STEP))


def byte_of(text: bytes, point: int) -> int:
    """The byte at which a code point begins, counted from 0; the end of the text if it has no more."""
    data = np.frombuffer(text, np.uint8)
    for at in range(0, len(data), tb.STEP):
        starts = np.flatnonzero(tb.POINT[data[at : at + tb.STEP]])
        if point < len(starts):
            return at + int(starts[point])
        point -= len(starts)
    return len(data)


def edited(text: bytes, following: bytes) -> tuple[bytes, int]:
    """The text with its last floor(n/2) code points replaced by as many first ones of the following text; and n."""
    n = code_points(text)
    half = n // 2
    return text[: byte_of(text, n - half)] + following[: byte_of(following, half)], n


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and fingerprint of every row: one map, no shuffle. Null texts are empty."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [written(signatures(np.frombuffer(t, np.uint8))) for t in raw_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["doc_id", "fingerprint"])

    return docs.select("doc_id", F.col(text)).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def ranges(docs: DataFrame, parts: int) -> list:
    """At most `parts` doc_ids, ascending, that part the documents evenly; the first document starts the first range."""
    return sorted({v for v in docs.select(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 10_000)).first()[0] or []}) if parts > 1 else []


def compare_with_next(docs: DataFrame, parts: int | None = None, text: str = "text") -> DataFrame:
    """Every text fingerprinted, edited with the next document's beginning, and compared with both.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Documents are in ascending
    order of doc_id (nulls first, ties by text); after the last comes the first.

    The documents are cut into `parts` ranges of doc_id at approximate quantiles; a range is one partition, sorted and
    streamed two texts at a time. The text after a range's last is that of the next range's first document, which is sent
    to both. Only the first doc_id of each range comes to the driver.

    Null texts are empty. Rows that repeat a doc_id follow each other. A table of one row is its own next; an empty
    table gives none. Other columns of `docs` are not read. doc_id must be an integer.
    """
    spark = docs.sparkSession
    ship_package(spark)
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("__text"))
    cuts = ranges(docs, parts)

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(cuts, np.int64), ids.fillna(-(1 << 63)).astype("int64"), side="right").astype(np.int32))

    placed = rows.withColumn("__part", place(F.col("doc_id").cast("long")) if cuts else F.lit(0))
    firsts = placed.groupBy("__part").agg(F.min(F.struct("doc_id")).alias("first")).orderBy("__part").collect()  # one row a range
    if not firsts:
        return spark.createDataFrame([], _schema(docs))
    # the first document of a range also ends the range before it, that of the first range the last one
    ended = [(r["__part"], r["first"]["doc_id"], firsts[i - 1]["__part"]) for i, r in enumerate(firsts)]
    id_type = docs.schema["doc_id"].dataType.simpleString()
    known = F.broadcast(spark.createDataFrame(ended, f"__of int, __first {id_type}, __ends int"))
    # where rows repeat that doc_id, the smallest text is first
    lead = placed.join(known, (placed["__part"] == known["__of"]) & placed["doc_id"].eqNullSafe(known["__first"])).groupBy("__ends").agg(F.min("__text").alias("__text"))
    tails = lead.select(F.lit(None).cast(id_type).alias("doc_id"), "__text", F.col("__ends").alias("__part"), F.lit(True).alias("__tail"))
    streamed = placed.withColumn("__tail", F.lit(False)).unionByName(tails).repartitionById(len(cuts) + 1, F.col("__part")).sortWithinPartitions("__part", "__tail", "doc_id", "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the document whose next has not come yet: id, text, signatures
        for batch in batches:
            out: dict[str, list] = {name: [] for name in _NAMES}
            pairs = []
            for key, value, tail in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                own = signatures(np.frombuffer(value, np.uint8))
                if held is not None:
                    changed, n = edited(held[1], value)
                    other = signatures(np.frombuffer(changed, np.uint8))
                    for name, v in zip(_NAMES, (held[0], n, hashlib.sha256(changed).hexdigest(), written(held[2]), written(other)), strict=False):
                        out[name].append(v)
                    pairs += [(held[2], other), (held[2], own)]
                held = None if tail else (key, value, own)
            near = likeness(pairs)
            yield pa.RecordBatch.from_arrays([pa.array(out["doc_id"], batch.schema.field(0).type), *(pa.array(out[c], t) for c, t in zip(_NAMES[1:5], (pa.int64(), pa.string(), pa.string(), pa.string()), strict=True)), pa.array(near[::2], pa.float64()), pa.array(near[1::2], pa.float64())], names=_NAMES)

    return streamed.select("doc_id", "__text", "__tail").mapInArrow(run, _schema(docs))


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _schema(docs: DataFrame) -> T.StructType:
    kinds = [docs.schema["doc_id"].dataType, T.LongType(), T.StringType(), T.StringType(), T.StringType(), T.DoubleType(), T.DoubleType()]
    return T.StructType([T.StructField(n, k) for n, k in zip(_NAMES, kinds, strict=True)])
