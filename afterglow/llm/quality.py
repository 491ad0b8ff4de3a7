"""Quality rules: statistics of whole texts, judged by an isolation forest calibrated on labelled rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from afterglow.llm import textblocks as tb
from afterglow.session import ship_package

#: Labelled rows, at most, that the forest is fitted and calibrated on.
SAMPLE_ROWS = 20_000
#: Trees, and rows that each is grown on.
TREES, TREE_SAMPLE = 100, 2_048
#: Rows labelled bad, as a share of a tree's other rows.
RARE_SHARE = 0.04
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What the forest splits on. Plain length is no part of it: the base rules judge that.
RATIOS = ("symbol_share", "dup_line_share", "repeat_word_share", "word_length", "upper_share", "mark_share", "same_next_share", "top_word_share")
REPEAT_WIDTH = 8
UPPER, MARK = tb.byte_set(bytes(range(65, 91))), tb.byte_set(b"!")


def statistics(block: tb.Block) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The base counts of each text, and its ratios as a matrix with a row for each text."""
    n = block.n
    starts, ends = block.words
    text = block.word_text
    n_words = np.diff(block.word_edges)
    word_chars, n_symbols = block.count(tb.WORD_POINT), block.count(tb.SYMBOL)
    # lines with a word
    line_start, line_end, line_text = block.lines
    solid = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_start, line_end, line_text = line_start[solid], line_end[solid], line_text[solid]
    n_lines = np.bincount(line_text, minlength=n)
    n_dup_lines = n_lines - np.bincount(tb.run_lengths(line_text, tb.byte_hashes(block.data, line_start, line_end), n)[0], minlength=n)
    # windows of eight words inside one text
    hashes = block.word_hashes
    windows = tb.rolled(hashes, REPEAT_WIDTH)
    repeated = np.zeros(len(windows), bool)
    if n == 1:
        repeated = tb.repeated_in_text(text[: len(windows)], windows, 1)
    elif len(windows):
        whole = np.flatnonzero(text[: len(windows)] == text[REPEAT_WIDTH - 1 :])
        repeated[whole] = tb.repeated_in_text(text[whole], windows[whole], n)
    covered = tb.covered(repeated, REPEAT_WIDTH, len(hashes))
    n_repeat_words = np.bincount(text[covered], minlength=n)
    base = dict(zip(BASE, (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), strict=True))
    # the ratios
    some, chars = np.maximum(n_words, 1), np.maximum(word_chars, 1)
    same = np.flatnonzero((hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])) if len(hashes) else np.zeros(0, int)
    top = np.zeros(n)
    np.maximum.at(top, *tb.run_lengths(text, hashes, n))
    # the counts of short texts say little, so shares are drawn towards nothing
    damped = some + 10.0
    ratios = np.stack(
        [
            n_symbols / (chars + 40.0),
            n_dup_lines / (n_lines + 3.0),
            n_repeat_words / damped,
            np.where(n_words > 0, np.clip(word_chars / some, 3, 8), 4.5),
            block.count(UPPER) / (chars + 40.0),
            block.count(MARK) / (chars + 40.0),
            np.bincount(text[same], minlength=n) / damped,
            np.where(top > 2, top / (some + 40.0), 0.0),
        ],
        axis=1,
    )
    return base, ratios


def telling(rows: np.ndarray, common: np.ndarray | None) -> np.ndarray:
    """For each statistic, how far its ranks alone part common rows from others, 0.02 at least; the same for all if none are others."""
    if common is None or common.all() or not common.any():
        return np.ones(rows.shape[1])
    out = []
    for column in rows.T:
        values = np.sort(column)
        rank = (np.searchsorted(values, column, "left") + np.searchsorted(values, column, "right")) / 2
        out.append(abs(2 * ((rank[~common].mean() - rank[common].mean()) / len(rows) + 0.5) - 1) + 0.02)
    return np.array(out)


@dataclass
class IsolationForest:
    """Trees of random cuts; few cuts isolate an anomalous row."""

    feature: np.ndarray  #: trees × nodes, -1 at leaves
    cut: np.ndarray
    length: np.ndarray  #: path length that ends at a leaf, with the expected rest for its rows
    expected: float
    threshold: float = 1.0

    @staticmethod
    def rest(n: np.ndarray | float) -> np.ndarray:
        """Expected path length of an unsuccessful search among n rows."""
        n = np.asarray(n, float)
        m = np.maximum(n, 3) - 1
        harmonic = np.log(m) + 0.5772156649 + 1 / (2 * m) - 1 / (12 * m**2)
        return np.where(n > 2, 2 * harmonic - 2 * m / (m + 1), np.where(n == 2, 1.0, 0.0))

    @classmethod
    def fit(cls, rows: np.ndarray, common: np.ndarray | None = None, trees: int = TREES, sample: int = TREE_SAMPLE, seed: int = 7) -> IsolationForest:
        """Trees over samples of the rows: each cut takes a random statistic that still differs, anywhere between its least and most.

        Rows that are not `common` (all are, if it is None) are thinned to RARE_SHARE of each sample, as what is many and alike
        is not isolated by few cuts, and statistics are drawn by how well each alone tells common rows from others. A tree sees
        half of the common rows at most, unless these are few: among all of them, rows that are alike hide each other."""
        rng = np.random.default_rng(seed)
        odds = telling(rows, common)
        usual = np.arange(len(rows)) if common is None or not common.any() else np.flatnonzero(common)
        rare = np.setdiff1d(np.arange(len(rows)), usual)
        usual_size = min(sample, max(len(usual) // 2, min(len(usual), 256)))
        rare_size = min(len(rare), max(1, round(RARE_SHARE * usual_size))) if len(rare) else 0
        sample = usual_size + rare_size
        depth = max(1, int(np.ceil(np.log2(max(sample, 2)))))
        nodes = 2 ** (depth + 1) - 1
        feature, cut, length = np.full((trees, nodes), -1), np.zeros((trees, nodes)), np.zeros((trees, nodes))
        for t in range(trees):
            drawn = [rng.choice(usual, usual_size, replace=False), rng.choice(rare, rare_size, replace=False)]
            todo = [(0, 0, rows[np.concatenate(drawn).astype(int)])]
            while todo:
                node, level, here = todo.pop()
                low, high = (here.min(0), here.max(0)) if len(here) else (np.zeros(0), np.zeros(0))
                wide = np.flatnonzero(high > low)
                if level == depth or len(here) < 2 or not len(wide):
                    length[t, node] = level + cls.rest(len(here))
                    continue
                f = rng.choice(wide, p=odds[wide] / odds[wide].sum())
                feature[t, node], cut[t, node] = f, rng.uniform(low[f], high[f])
                left = here[:, f] < cut[t, node]
                todo += [(2 * node + 1, level + 1, here[left]), (2 * node + 2, level + 1, here[~left])]
        return cls(feature, cut, length, float(cls.rest(sample)) or 1.0)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Near 1: isolated by few cuts. About 0.5 and less: ordinary."""
        total, every = np.zeros(len(rows)), np.arange(len(rows))
        for feature, cut, length in zip(self.feature, self.cut, self.length, strict=True):
            at = np.zeros(len(rows), np.int64)
            while True:
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                at = np.where(inner, 2 * at + 1 + (rows[every, np.maximum(f, 0)] >= cut[at]), at)
            total += length[at]
        return 2.0 ** (-total / len(self.feature) / self.expected)

    def calibrate(self, rows: np.ndarray, good: np.ndarray, loss: float = 10.0) -> None:
        """Set the threshold that rejects most bad rows, a rejected good row weighing `loss` times its share."""
        scores = self.score(rows)
        if good.all() or not good.any():
            self.threshold = float(scores[good].max()) if good.any() else 1.0
            return
        order = np.argsort(-scores, kind="stable")
        ranked, bad = scores[order], ~good[order]
        gain = np.cumsum(bad) / bad.sum() - loss * np.cumsum(~bad) / (~bad).sum()
        last = np.append(np.diff(ranked) != 0, True)  # cuts only between different scores
        best = int(np.argmax(np.where(last, gain, -np.inf)))
        if gain[best] <= 0:
            self.threshold = 1.0
        else:
            self.threshold = float((ranked[best] + (ranked[best + 1] if best + 1 < len(ranked) else ranked[best])) / 2)


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, text: str, *extra: str) -> DataFrame:
    """Texts and quality labels of labelled documents, at most `rows` labels picked by the hash of their doc_id, `__order`.

    The labels are broadcast, the texts stay where they are read. A doc_id that repeats in `docs` gives a row each time, so
    whoever gathers them takes the first `rows` by `__order`.
    """
    hashed = F.xxhash64(F.col("doc_id").cast("string"))
    usable = labels.select("doc_id", F.col("quality").cast("int").alias("__quality")).dropna()
    if (n := usable.count()) > 2 * rows:  # the smallest hashes lie below this bound, so few rows are ever sorted
        usable = usable.filter(hashed <= int(-(2**63) + 2**64 * 1.2 * rows / n))
    picked = usable.orderBy(hashed, "doc_id", "__quality").limit(rows)
    return docs.select("doc_id", F.col(text).alias("__text"), *extra).join(F.broadcast(picked), "doc_id").withColumn("__order", hashed)


def fit_rules(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, trees: int = TREES, tree_sample: int = TREE_SAMPLE, text: str = "text") -> IsolationForest | None:
    """The forest of the rule statistics of at most `sample_rows` labelled documents; None without any.

    Labels thin bad rows in the trees' samples, weigh the draw of statistics, and calibrate the threshold.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tb.blocks(batch.column(0)):
                ratios = statistics(block)[1]
                yield pa.RecordBatch.from_arrays([pa.array(list(ratios), pa.list_(pa.float64())), *(batch.column(i).slice(block.rows[0], block.n) for i in (1, 2))], names=["ratios", "quality", "order"])

    sample = labelled_sample(docs, labels, sample_rows, text).select("__text", "__quality", "__order")
    described = sample.mapInArrow(run, "ratios array<double>, quality int, order long")
    found = described.orderBy("order", "quality", "ratios").limit(sample_rows).collect()  # statistics, not texts
    if not found:
        return None
    rows, good = np.array([r["ratios"] for r in found]), np.array([r["quality"] == 1 for r in found])
    forest = IsolationForest.fit(rows, good, trees, tree_sample)
    forest.calibrate(rows, good)
    return forest


def verdicts(block: tb.Block, forest: IsolationForest | None, min_words: int, repeat_percent: int) -> dict[str, np.ndarray]:
    """Base counts, base_failed, anomaly and kept of each text."""
    base, ratios = statistics(block)
    failed = (base["n_words"] < min_words) | (100 * base["n_repeat_words"] > repeat_percent * base["n_words"])
    anomaly = forest.score(ratios) if forest else np.zeros(block.n)
    kept = ~failed & ((anomaly <= forest.threshold) if forest else True)
    return {**base, "base_failed": failed, "kept": kept, "anomaly": anomaly}


def judge(docs: DataFrame, labels: DataFrame, min_words: int = 20, repeat_percent: int = 30, sample_rows: int = SAMPLE_ROWS, text: str = "text") -> DataFrame:
    """doc_id, the base counts, base_failed, kept and anomaly of every whole text.

    Words are runs outside [\\x20\\x09-\\x0D]. `base_failed`: fewer than `min_words` words, or more than `repeat_percent`
    percent of them in windows of eight words that the text holds twice. Others are kept if the isolation forest, fitted
    on at most `sample_rows` labelled rows, finds their anomaly at or under the threshold calibrated on those labels;
    without labels the base rules alone decide.

    One map over the rows, no shuffle; the forest is a broadcast of fixed size. A null text has no words, so it fails.
    Every row, repeated or with a null doc_id, gives one row; an empty table gives none. Labels that are null are passed
    over. Other columns of `docs` are not read.
    """
    forest = docs.sparkSession.sparkContext.broadcast(fit_rules(docs, labels, sample_rows, text=text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tb.blocks(batch.column(1)):
                found = verdicts(block, forest.value, min_words, repeat_percent)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.rows[0], block.n), *(pa.array(v) for v in found.values())], names=["doc_id", *found])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, {', '.join(f'{c} long' for c in BASE)}, base_failed boolean, kept boolean, anomaly double"
    return docs.select("doc_id", F.col(text)).mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame, min_words: int = 20, repeat_percent: int = 30, sample_rows: int = SAMPLE_ROWS, text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns as they are, that `judge` keeps: a null or empty text never is, rows that repeat fare
    alike, an empty table gives none, and a null doc_id is as good as any."""
    forest = docs.sparkSession.sparkContext.broadcast(fit_rules(docs, labels, sample_rows, text=text))
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [verdicts(block, forest.value, min_words, repeat_percent)["kept"] for block in tb.blocks(batch.column(at))]
            if kept:
                yield batch.filter(pa.array(np.concatenate(kept)))

    return docs.mapInArrow(run, docs.schema)
