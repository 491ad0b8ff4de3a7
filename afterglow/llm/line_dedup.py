"""Line dedup: drop lines that occur in many documents, with DataFrame functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space stripped at both ends of a line before it is compared.
STRIPPED = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line stripped of ASCII white space at both ends, with A-Z lower-cased.

    `lower` has a fast path for ASCII and there changes A-Z only; other lines take `translate`.
    """
    stripped = F.btrim(line, F.lit(STRIPPED))
    ascii_only = F.octet_length(line) == F.char_length(line)
    return F.when(ascii_only, F.lower(stripped)).otherwise(F.translate(stripped, string.ascii_uppercase, string.ascii_lowercase))


def line_hash(line: Column, min_chars: int) -> Column:
    """MD5 of a line's key as 16 bytes; null for keys shorter than `min_chars` code points."""
    key = line_key(line)
    return F.when(F.char_length(key) >= min_chars, F.unhex(F.md5(key)))


def lines_of(text: Column) -> Column:
    """A text's lines; a null or empty text has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


#: Parts that the occurrences of one line are dealt to.
SALTS = 32


def drop_common_lines(docs: DataFrame, min_documents: int = 10, min_chars: int = 1, text: str = "text") -> DataFrame:
    """All rows and columns of `docs`, plus `kept_text`, `n_lines` and `n_dropped`.

    A line whose key has at least `min_chars` code points and occurs in at least `min_documents` documents
    goes from every document; the other lines stay in their order, joined by a line feed. Documents are counted by doc_id.

    Lines are exploded once, as (hash, document, position), and dealt by hash and a salt of the document, so a line that a
    third of all documents share lies in SALTS tasks. A document's lines of one hash meet in one task, so documents are
    counted there and the counts added up; the frequent hashes go back to the same dealt lines, each to all its salts.
    Only their positions come back to the documents. The outer form of explode keeps Spark from hashing every line again for a
    filter that it would infer.

    Null or empty text: one line, the empty one, which `min_chars` > 0 never drops. Rows that repeat a doc_id count as one
    document for a line and each keeps its row; a null doc_id is no document that counts, but loses frequent lines as well. An
    empty table gives an empty result. Columns of the same name as a new one are replaced; all others pass through.
    """
    named = [c for c in docs.columns if c not in ("kept_text", "n_lines", "n_dropped")]
    own = [F.col("doc_id").alias("__id"), F.xxhash64(F.col(text)).alias("__of")]
    rows = docs.select(F.struct(*own).alias("__key"), F.struct(*named).alias("__row"))
    hashes = F.transform(lines_of(F.col(text)), lambda line: line_hash(line, min_chars))
    salt = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"), F.lit(0))  # known not to be null
    lines = docs.select(*own, salt.alias("__salt"), F.posexplode_outer(hashes).alias("__pos", "__hash")).filter(F.col("__hash").isNotNull())
    dealt = lines.repartition("__hash", "__salt")
    # every column is asked for here as well, so that both readers of the dealt lines read one and the same exchange
    by_document = dealt.groupBy("__hash", "__salt", "__id").agg(F.max("__pos").alias("__last"), F.max(F.col("__of").bitwiseAND(1)).alias("__bit"))
    counts = by_document.groupBy("__hash").agg(F.count_if(F.col("__id").isNotNull() & (F.col("__last") + F.col("__bit") >= 0)).alias("__documents"))
    frequent = counts.filter(F.col("__documents") >= min_documents).select("__hash", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt")).repartition("__hash", "__salt")
    # an inner join, as each pair is there once: a semi join would be moved below the exchange
    dropped = dealt.join(frequent, ["__hash", "__salt"]).groupBy(F.struct("__id", "__of").alias("__key")).agg(F.collect_set("__pos").alias("__drop"))
    lines_now = F.col("__lines")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines_now) - 1), F.coalesce(F.col("__drop"), F.array().cast("array<int>")))
    return (
        rows.join(dropped, "__key", "left")
        .withColumn("__lines", lines_of(F.col(f"__row.{text}")))
        .withColumn("__stay", stay)
        .select(
            "__row.*",
            F.array_join(F.transform("__stay", lambda i: F.get(lines_now, i)), "\n").alias("kept_text"),
            F.size(lines_now).cast("long").alias("n_lines"),
            (F.size(lines_now) - F.size("__stay")).cast("long").alias("n_dropped"),
        )
    )
