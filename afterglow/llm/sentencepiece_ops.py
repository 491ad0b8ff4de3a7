"""DataFrame operators for SentencePiece ids: encode and decode documents, and count tokens."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from afterglow.llm import piece_bpe
from afterglow.llm.rows import raw_texts
from afterglow.session import materialise, ship_package

#: Distinct pre-tokens that a worker sums up before it sends them on.
TABLE_ENTRIES = 200_000
#: Frequent pre-tokens, at most, that are broadcast; each has at most `piece_bpe.CACHED_CHARS` characters.
HEAD_ENTRIES = 400_000


def encode_documents(docs: DataFrame, model_path: str, digest: bool = False, text: str = "text") -> DataFrame:
    """Encode every whole text with the prefix table and decode the ids again: doc_id, n_tokens, and either
    `ids` and `decoded`, or with `digest` only their SHA-256 (`ids_sha256` of the decimal ids joined by commas).

    One map over the rows, no shuffle. A null text counts as empty and has no ids. Every row, repeated or with a null
    doc_id, gives one row; an empty table gives none. Other columns of `docs` are not read. Pre-tokens are encoded
    once each while a worker's cache of `piece_bpe.CACHE_ENTRIES` holds them, then anew.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = piece_bpe.pre_token_cache(model_path)
        for batch in batches:
            counts, ids, decoded = [], [], []
            for value in raw_texts(batch.column(1)):
                listed, back, count = hashlib.sha256() if digest else [], hashlib.sha256() if digest else [], 0
                for part in piece_bpe.pre_token_parts(value):
                    found = [cache[chunk] for chunk in part]
                    text_ids, surface = ",".join([x[0] for x in found]), "".join([x[1] for x in found])
                    if not count:
                        surface = surface[1:]  # the encoder's own space
                    elif digest:
                        listed.update(b",")
                    count += text_ids.count(",") + 1
                    if digest:
                        listed.update(text_ids.encode())
                        back.update(surface.encode("utf-8"))
                    else:
                        listed += map(int, text_ids.split(","))
                        back.append(surface)
                    if len(cache) > piece_bpe.CACHE_ENTRIES:
                        cache.clear()
                counts.append(count)
                ids.append(listed.hexdigest() if digest else listed)
                decoded.append(back.hexdigest() if digest else "".join(back))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string() if digest else pa.list_(pa.int32())), pa.array(decoded, pa.string())], names=names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digest else ["doc_id", "n_tokens", "ids", "decoded"]
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens long, {names[2]} {'string' if digest else 'array<int>'}, {names[3]} string"
    return docs.select("doc_id", F.col(text)).mapInArrow(run, schema)


def pre_token_table(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """(chunk, n, pieces): each distinct pre-token of up to `piece_bpe.CACHED_CHARS` characters, how often it occurs, and how many
    pieces the library makes of it, asked once.

    Workers sum up occurrences until their table has TABLE_ENTRIES, then send it on, so a frequent pre-token is a few rows a task.
    """
    ship_package(docs.sparkSession)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: Counter[str] = Counter()
        for batch in batches:
            for value in raw_texts(batch.column(0)):
                for part in piece_bpe.pre_token_parts(value):
                    table.update(part)
                    if len(table) > TABLE_ENTRIES:
                        yield from _rows(table)
                        table.clear()
        yield from _rows(table)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks = batch.column(0).to_pylist()
            pieces = piece_counts(chunks, model_path)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([pieces[c] for c in chunks], pa.int64())], names=["chunk", "n", "pieces"])

    found = docs.select(F.col(text)).mapInArrow(summed, "chunk string, n long").groupBy("chunk").agg(F.sum("n").alias("n"))
    return found.mapInArrow(counted, "chunk string, n long, pieces long")


def _rows(table: dict[str, int]) -> Iterator[pa.RecordBatch]:
    """A table's short pre-tokens as Arrow batches."""
    short = [(c, n) for c, n in table.items() if len(c) <= piece_bpe.CACHED_CHARS]
    for at in range(0, len(short), 10_000):
        part = short[at : at + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in part], pa.string()), pa.array([n for _, n in part], pa.int64())], names=["chunk", "n"])


def most_frequent(table: DataFrame, entries: int) -> dict[str, int]:
    """Pre-token → pieces of the most frequent ones: all that occur at least so many times, a power of two, at most `entries`."""
    sizes = {r["power"]: r["count"] for r in table.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).count().collect()}  # at most 63 rows
    power, room = 63, entries
    while power and (room := room - sizes.get(power - 1, 0)) >= 0:
        power -= 1
    found = table.filter(F.floor(F.log2("n")) >= power).select("chunk", "pieces").toArrow()
    return dict(zip(found["chunk"].to_pylist(), found["pieces"].to_pylist(), strict=True))


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, text: str = "text", head_entries: int = HEAD_ENTRIES) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of every whole text.

    The library counts the pieces of each distinct pre-token of the corpus once (`pre_token_table`). Documents' pre-token
    frequencies are joined to that table and summed; no ids are made. The at most `head_entries` most frequent pre-tokens are
    broadcast and summed where the text is read, which leaves no key in the join that many rows share; the frequencies
    of the others are dealt by pre-token, joined, and summed by row. Pre-tokens of more than `piece_bpe.CACHED_CHARS`
    characters are counted where they stand.

    A null text counts as empty: no bytes, no tokens. Every row, repeated or with a null doc_id, gives one row; an empty
    table gives none. Other columns of `docs` are not read.
    """
    spark = docs.sparkSession
    table = materialise(pre_token_table(docs, model_path, text))
    head = spark.sparkContext.broadcast(most_frequent(table, head_entries))
    id_type = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, row = head.value, TaskContext.get().partitionId() << 40
        for batch in batches:
            rows, source, chunks, counts, sizes, tokens = [], [], [], [], [], []
            for i, value in enumerate(raw_texts(batch.column(1))):
                frequency: Counter[str] = Counter()
                total = 0
                for part in piece_bpe.pre_token_parts(value):
                    frequency.update(part)
                    if len(frequency) > TABLE_ENTRIES:
                        total += _leave(frequency, known, model_path, rows, chunks, counts, row)
                total += _leave(frequency, known, model_path, rows, chunks, counts, row)
                source += [None] * (len(rows) - len(source))
                # the row itself, under a name that is no pre-token
                rows.append(row)
                source.append(i)
                chunks.append(f"\n{row}")
                counts.append(None)
                sizes.append(len(value))
                tokens.append(total)
                row += 1
            own = pa.array(source, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), batch.column(0).take(own), pa.array(chunks, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64()).take(own), pa.array(tokens, pa.int64()).take(own)], names=["row", "doc_id", "chunk", "n", "n_bytes", "tokens"])

    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("doc_id", id_type), T.StructField("chunk", T.StringType()), *(T.StructField(c, T.LongType()) for c in ("n", "n_bytes", "tokens"))])
    parted = docs.select("doc_id", F.col(text)).mapInArrow(run, schema).join(table.select("chunk", "pieces"), "chunk", "left")
    found = parted.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum(F.coalesce("tokens", F.col("n") * F.col("pieces"))).alias("n_tokens"))
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _leave(frequency: Counter[str], known: dict[str, int], model_path: str, rows: list, chunks: list, counts: list, row: int) -> int:
    """Tokens of the known and the long pre-tokens; the others are listed for the join, and the frequencies emptied."""
    total, long = 0, []
    for chunk, n in frequency.items():
        pieces = known.get(chunk)
        if pieces is not None:
            total += n * pieces
        elif len(chunk) > piece_bpe.CACHED_CHARS:
            long.append(chunk)
        else:
            rows.append(row)
            chunks.append(chunk)
            counts.append(n)
    for chunk in long:
        total += frequency[chunk] * piece_counts([chunk], model_path)[chunk]
    frequency.clear()
    return total


def piece_counts(chunks: list[str], model_path: str) -> dict[str, int]:
    """How many pieces the library makes of each pre-token.

    The library puts a space mark before each text. It stands for the first mark of a pre-token that has one; others
    go behind a line feed, which nothing merges with, and lose the two ids of mark and line feed again.
    """
    if not chunks:
        return {}
    mark = piece_bpe.SPACE
    asked = [chunk[1:] if chunk[0] == mark else "\n" + chunk for chunk in chunks]
    ids = piece_bpe.library(model_path).encode(asked, num_threads=1)
    return {chunk: (len(found) or 1) if chunk[0] == mark else len(found) - 2 for chunk, found in zip(chunks, ids, strict=True)}
