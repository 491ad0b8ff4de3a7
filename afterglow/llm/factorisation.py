"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from afterglow.llm import quality
from afterglow.llm import textblocks as tb
from afterglow.session import ship_package

#: Labelled rows, at most, that the machine learns from.
SAMPLE_ROWS = 8_000
WORD_BUCKETS = 1 << 14
#: Steps that each structure statistic is cut into, at quantiles of the learned rows.
STEPS = 16
LENGTH_BUCKETS = 24
NAMES = (*quality.RATIOS, "distinct_share", "words_per_line", "punctuation_share", "digit_share", "long_word_share")
PUNCTUATION, DIGIT = tb.byte_set(b".,;:?()'\"-"), tb.byte_set(b"0123456789")


@dataclass
class Rows:
    """Sparse rows: row i has the features index[edges[i]:edges[i+1]]."""

    edges: np.ndarray
    index: np.ndarray
    value: np.ndarray

    def take(self, rows: np.ndarray) -> Rows:
        sizes = np.diff(self.edges)[rows]
        edges = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(self.edges[rows] - edges[:-1], sizes) + np.arange(edges[-1])
        return Rows(edges, self.index[at], self.value[at])


def described(block: tb.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Structure statistics of each text; and text, bucket and weight of each of its different word buckets."""
    base, ratios = quality.statistics(block)
    n, text, hashes = block.n, block.word_text, block.word_hashes
    bucket = (hashes % np.uint64(WORD_BUCKETS)).astype(np.int64)
    if n == 1:
        counts = np.bincount(bucket, minlength=WORD_BUCKETS)
        bucket = np.flatnonzero(counts)
        of, counts = np.zeros(len(bucket), np.int64), counts[bucket]
    else:
        pairs, counts = np.unique(text.astype(np.int64) * WORD_BUCKETS + bucket, return_counts=True)
        of, bucket = pairs // WORD_BUCKETS, pairs % WORD_BUCKETS
    weight = np.log1p(counts)
    norm = np.sqrt(np.bincount(of, weight**2, minlength=n))
    words, chars = np.maximum(base["n_words"], 1), np.maximum(base["word_chars"], 1)
    starts, ends = block.words
    lines = np.bincount(block.lines[2], minlength=n)
    more = np.stack(
        [
            np.bincount(of, minlength=n) / words**0.8,
            np.log1p(words / np.maximum(lines, 1)),
            block.count(PUNCTUATION) / chars,
            block.count(DIGIT) / chars,
            np.bincount(text[(ends - starts) > 12], minlength=n) / words,
        ],
        axis=1,
    )
    return np.concatenate([ratios, more], axis=1), of, bucket, weight / norm[of]


@dataclass
class Machine:
    """score(x) = w0 + w·x + sum over pairs of <v_i, v_j> x_i x_j, through a logistic and a calibrated shift."""

    cuts: np.ndarray  #: statistics × (STEPS - 1)
    w0: float
    w: np.ndarray
    v: np.ndarray
    shift: float = 0.0
    scale: float = 1.0

    @staticmethod
    def rows(stats: np.ndarray, of: np.ndarray, bucket: np.ndarray, weight: np.ndarray, n_chars: np.ndarray, cuts: np.ndarray) -> Rows:
        """Sparse rows: word buckets with unit length together, one step of each statistic, one bucket of n_chars."""
        n, k = stats.shape
        step = np.stack([np.searchsorted(cuts[j], stats[:, j], side="right") for j in range(k)], axis=1) if n else np.zeros((0, k), int)
        steps = WORD_BUCKETS + np.arange(k) * STEPS + step
        long = np.where(n_chars < 0, 0, 1 + np.log2(np.maximum(n_chars, 0) + 1).astype(int).clip(0, LENGTH_BUCKETS - 2))
        dense = np.concatenate([steps, (WORD_BUCKETS + k * STEPS + long)[:, None]], axis=1)
        row = np.concatenate([of, np.repeat(np.arange(n), k + 1)])
        index, value = np.concatenate([bucket, dense.ravel()]), np.concatenate([weight, np.full(n * (k + 1), 0.5)])
        order = np.argsort(row, kind="stable")
        return Rows(np.searchsorted(row[order], np.arange(n + 1)), index[order], value[order])

    def raw(self, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the logistic, and the sums per factor: pairs cost no more than a sum and a sum of squares."""
        starts = rows.edges[:-1]  # no row is empty: each has its statistics
        if not len(starts):
            return np.zeros(0), np.zeros((0, self.v.shape[1]))
        sums, squares = np.empty((len(starts), self.v.shape[1])), np.zeros(len(starts))
        for f in range(self.v.shape[1]):
            x = self.v[rows.index, f] * rows.value
            sums[:, f] = np.add.reduceat(x, starts)
            squares += np.add.reduceat(x * x, starts)
        linear = np.add.reduceat(self.w[rows.index] * rows.value, starts)
        return self.w0 + linear + 0.5 * ((sums**2).sum(1) - squares), sums

    def score(self, rows: Rows) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.raw(rows)[0] + self.shift, -30, 30)))

    @classmethod
    def fit(cls, make_rows, cuts: np.ndarray, labels: np.ndarray, factors: int = 6, epochs: int = 12, rate: float = 0.15, decay: float = 1e-4, batch: int = 128, seed: int = 11) -> Machine:
        """Learn by AdaGrad on the logistic loss, both classes weighing the same."""
        rng = np.random.default_rng(seed)
        size = WORD_BUCKETS + len(cuts) * STEPS + LENGTH_BUCKETS
        machine = cls(cuts, 0.0, np.zeros(size), rng.normal(0, 0.05, (size, factors)))
        rows = make_rows(cuts)
        weight = np.where(labels == 1, 0.5 / max((labels == 1).mean(), 1e-9), 0.5 / max((labels == 0).mean(), 1e-9))
        seen_w, seen_v, seen_0 = np.full(size, 1e-6), np.full((size, factors), 1e-6), 1e-6
        for _ in range(epochs):
            order = rng.permutation(len(labels))
            for at in range(0, len(order), batch):
                chosen = order[at : at + batch]
                part = rows.take(chosen)
                raw, sums = machine.raw(part)
                slope = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[chosen]) * weight[chosen] / len(chosen)
                each, index = np.repeat(slope, np.diff(part.edges)), part.index
                grad = np.bincount(index, each * part.value, size)
                touched = np.flatnonzero(np.bincount(index, minlength=size))
                grad = grad[touched] + decay * machine.w[touched]
                seen_w[touched] += grad**2
                machine.w[touched] -= rate * grad / np.sqrt(seen_w[touched])
                of = np.repeat(np.arange(len(chosen)), np.diff(part.edges))
                for f in range(factors):
                    own = machine.v[index, f]
                    g = np.bincount(index, each * part.value * (sums[of, f] - own * part.value), size)[touched] + decay * machine.v[touched, f]
                    seen_v[touched, f] += g**2
                    machine.v[touched, f] -= 0.3 * rate * g / np.sqrt(seen_v[touched, f])
                seen_0 += slope.sum() ** 2
                machine.w0 -= rate * slope.sum() / np.sqrt(seen_0)
        return machine

    def calibrate(self, rows: Rows, labels: np.ndarray, at: float = 0.3) -> None:
        """Shift scores so that `at` is where rows not fitted are best parted, both classes weighing the same."""
        raw = self.raw(rows)[0]
        if labels.min(initial=1) == labels.max(initial=0):
            return
        good, bad = np.sort(raw[labels == 1]), np.sort(raw[labels == 0])
        edges = np.unique(raw)
        gain = np.searchsorted(bad, edges) / len(bad) - np.searchsorted(good, edges) / len(good)
        best = np.flatnonzero(gain >= gain.max() - 1e-12)
        i = int(best[len(best) // 2])
        border = (edges[i] + edges[i - 1]) / 2 if i else edges[0]
        self.shift = float(np.log(at / (1 - at)) - self.scale * border)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, tb.Block, tuple, np.ndarray]]:
    """Blocks of batches whose first columns are the text and n_chars."""
    for batch in batches:
        chars = batch.column(1).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        for block in tb.blocks(batch.column(0)):
            yield batch, block, described(block), chars[block.rows]


def fit_classifier(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, text: str = "text") -> Machine | None:
    """A machine learned from at most `sample_rows` labelled documents outside the held-out fifth; None without both classes."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block, (stats, of, bucket, weight), chars in _features(batches):
            edges = np.searchsorted(of, np.arange(block.n + 1))
            lists = lambda x, t: pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(x, t))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(stats), pa.list_(pa.float64())), lists(bucket, pa.int32()), lists(weight, pa.float32()), pa.array(chars), *(batch.column(i).slice(block.rows[0], block.n) for i in (2, 3, 4))],
                names=["stats", "bucket", "weight", "chars", "quality", "key", "order"],
            )

    usable = labels.filter(~held_out(F.col("doc_id")))
    sample = quality.labelled_sample(docs, usable, sample_rows, text, chars_of(docs).alias("__chars"))
    sample = sample.select("__text", "__chars", "__quality", F.xxhash64(F.col("doc_id").cast("string"), "__text").alias("__key"), "__order")
    described_rows = sample.mapInArrow(run, "stats array<double>, bucket array<int>, weight array<float>, chars long, quality int, key long, order long")
    found = described_rows.orderBy("order", "key", "quality").limit(sample_rows).drop("order").toArrow()  # features, not texts
    found = found.sort_by("key").combine_chunks()
    target = np.array([int(q == 1) for q in found["quality"].to_pylist()])
    if len(set(target.tolist())) < 2:
        return None
    stats = np.array(found["stats"].to_pylist())
    bucket = found["bucket"].combine_chunks()
    sizes = np.diff(bucket.offsets.to_numpy())
    of, flat = np.repeat(np.arange(len(target)), sizes), bucket.flatten().to_numpy().astype(np.int64)
    weight, chars = found["weight"].combine_chunks().flatten().to_numpy().astype(float), found["chars"].to_numpy()
    cuts = np.quantile(stats, np.linspace(0, 1, STEPS + 1)[1:-1], axis=0).T
    everything = Machine.rows(stats, of, flat, weight, chars, cuts)
    tuned = np.arange(len(target)) % 5 == 0  # in order of a hash; not fitted, places the threshold
    if len(set(target[tuned].tolist())) < 2 or len(set(target[~tuned].tolist())) < 2:
        tuned = np.ones(len(target), bool)
        fitted = tuned
    else:
        fitted = ~tuned
    machine = Machine.fit(lambda c: everything.take(np.flatnonzero(fitted)), cuts, target[fitted])
    machine.calibrate(everything.take(np.flatnonzero(tuned)), target[tuned])
    return machine


def held_out(doc_id):
    """Whether crc32(doc_id as text) mod 5 is 0; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def chars_of(docs: DataFrame):
    """The n_chars column as metadata, null where there is none."""
    return F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample_rows: int = SAMPLE_ROWS, text: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: better) and predicted (score >= threshold) of every whole text.

    The machine learns from at most `sample_rows` labelled rows outside the held-out fifth. Inputs are hashed words,
    structure statistics of the text and the n_chars column; never labels, lang, source or doc_id. A score costs time
    linear in the text: pairs are summed as half the square of sums less the sum of squares, factor by factor.

    One map over the rows, no shuffle; the machine is a broadcast of fixed size. Null and empty texts have no words and
    are scored by their statistics. Every row, repeated or with a null doc_id, gives one row; an empty table gives none.
    Without labels of both classes every score is 0.5. Other columns are not read.
    """
    machine = docs.sparkSession.sparkContext.broadcast(fit_classifier(docs, labels, sample_rows, text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = machine.value
        for batch, block, (stats, of, bucket, weight), chars in _features(batches):
            score = model.score(Machine.rows(stats, of, bucket, weight, chars, model.cuts)) if model else np.full(block.n, 0.5)
            cut = lambda i: batch.column(i).slice(block.rows[0], block.n)
            yield pa.RecordBatch.from_arrays([cut(2), cut(3), pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(F.col(text), chars_of(docs), "doc_id", held_out(F.col("doc_id"))).mapInArrow(run, f"doc_id {id_type}, held_out boolean, score double, predicted int")
