"""SimHash near-dedup: fingerprints, covering locality-sensitive hashing, bands of smallest hashes, and components of linked documents."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from afterglow.llm import textblocks as tb
from afterglow.llm.rows import raw_texts
from afterglow.session import materialise, ship_package

#: XXH64 seed of shingles.
SEED = 42
#: A bucket with more different members than this is covered again on the bits they may differ in.
BUCKET_LIMIT = 256
#: Bands of a text's sketch and smallest hashes in each; texts a document is compared with in each bucket of a band.
BANDS, BAND_ROWS, NEIGHBOURS = 20, 5, 256
_draws = np.random.default_rng(SEED).integers(0, 1 << 63, (2, BANDS * BAND_ROWS), np.uint64)
OFFSETS, FACTORS = _draws[0] << np.uint64(1), _draws[1] << np.uint64(1) | np.uint64(1)
#: In larger buckets, texts outside the largest group are held in blocks of about so many, and all texts pass them in tiles of so many.
BLOCK, TILE = 512, 8192
#: Smallest hashes by which texts of one bucket are compared before their words are.
WIDE = 1024
_draws = np.random.default_rng(SEED + 1).integers(0, 1 << 63, (2, WIDE), np.uint64)
WIDE_OFFSETS, WIDE_FACTORS = _draws[0] << np.uint64(1), _draws[1] << np.uint64(1) | np.uint64(1)


def shingle_parts(text: bytes, width: int) -> Iterator[np.ndarray]:
    """XXH64 of each run of `width` words of a text with A-Z lower-cased, in parts of about a million bytes of text; of all
    words if there are fewer; none without words."""
    words: list[bytes] = []
    digest, some = xxhash.xxh64_intdigest, False
    for part in tb.windows_of(text):
        words += part.lower().split()
        if len(words) < width:
            continue
        joined = b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(sizes + 1) - sizes - 1
        ends = (starts + sizes)[width - 1 :].tolist()
        yield np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends, strict=False)], np.uint64)
        words, some = words[len(words) - width + 1 :], True
    if words and not some:
        yield np.array([digest(b" ".join(words), SEED)], np.uint64)


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """All of `shingle_parts`."""
    return np.concatenate([np.zeros(0, np.uint64), *shingle_parts(text, width)])


def fingerprint(hashes: np.ndarray) -> int:
    """The 64-bit number whose bits are set where more than half of the hashes have theirs set."""
    return majority([hashes])


def majority(parts: Iterable[np.ndarray]) -> int:
    """The fingerprint of hashes given in parts."""
    ones, count = np.zeros(64, np.int64), 0
    for hashes in parts:
        count += len(hashes)
        for at in range(0, len(hashes), 1 << 16):
            part = hashes[at : at + (1 << 16)]
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > count).tolist())


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, width: int, text: str) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed 64-bit number, of every row."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [signed(majority(shingle_parts(t, width))) for t in raw_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col(text)).mapInArrow(run, f"doc_id {id_type}, fp long")


@lru_cache
def _vectors(radius: int) -> list[int]:
    """The nonzero vectors of radius + 1 bits, ordered so that the first few already have odd products with every vector,
    as often for each as can be."""
    size = (2 << radius) - 1
    odd = [0] * (size + 1)
    found: list[int] = []
    left = list(range(1, size + 1))
    while left:
        best = max(left, key=lambda x: (sorted(odd[v] + ((x & v).bit_count() & 1) for v in range(1, size + 1)), -x))
        left.remove(best)
        found.append(best)
        for v in range(1, size + 1):
            odd[v] += (best & v).bit_count() & 1
    return found


def covering_masks(bits: list[int], radius: int = 2) -> list[int]:
    """2^(radius+1) - 1 masks over the given bits so that any `radius` of the bits are all outside one of them.

    Each bit carries a nonzero vector of radius + 1 bits, in turn; mask v keeps the bits whose vector has an odd product
    with v. So many vectors span less than the whole space, so some nonzero v is orthogonal to all of them: numbers that
    differ in `radius` or fewer of the bits agree under that mask. Of more than `radius` bits each mask keeps one at least.
    """
    vectors = _vectors(radius)
    return [sum(1 << b for i, b in enumerate(bits) if (vectors[i % len(vectors)] & v).bit_count() & 1) for v in range(1, len(vectors) + 1)]


@lru_cache(maxsize=1 << 14)
def masks_beyond(kept: int, radius: int) -> list[int]:
    """Masks that keep what `kept` keeps and cover the other bits."""
    return sorted({kept | mask for mask in covering_masks([b for b in range(64) if not kept >> b & 1], radius)})


def tables(depth: int, radius: int = 2) -> list[int]:
    """Kept bits of each table: covered once, or again on the bits left over, `depth` times."""
    found = [0]
    for _ in range(depth):
        found = sorted({mask for kept in found for mask in masks_beyond(kept, radius)})
    return found


def _links_in(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(value, smallest value linked to it in the bucket) for values within the radius of each other, transitively."""
    parent = np.arange(len(values))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    unsigned = values.view(np.uint64)
    for i in range(len(values) - 1):
        near = np.flatnonzero(np.bitwise_count(unsigned[i + 1 :] ^ unsigned[i]) <= radius)
        for j in near + i + 1:
            a, b = root(i), root(int(j))
            if a != b:
                parent[max(a, b)] = min(a, b)
    return [(int(values[i]), int(values[r])) for i in range(len(values)) if (r := root(i)) != i]


def links(found: DataFrame, radius: int = 2) -> DataFrame:
    """Edges (a, b) that join all different fingerprints within `radius` bits of each other, as star-shaped groups a bucket.

    `found` has each fingerprint `fp` once; null ones link to nothing and an empty table has no edges. Every pair within
    the radius meets in a bucket of some covering mask. A bucket of more than BUCKET_LIMIT is covered again on the bits that
    its members may still differ in, and so on: every time each mask keeps at least one more bit, mostly half of those left,
    and a bucket that keeps all but eight bits has 256 different members at most. So no bucket is cut, and none that is
    compared has more members than BUCKET_LIMIT or 2^(radius+1).
    """
    ship_package(found.sparkSession)
    limit = max(BUCKET_LIMIT, 2 << radius)
    first = [F.struct(F.lit(signed(m)).alias("kept"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("k")) for m in tables(1, radius)]
    keyed = found.filter("fp IS NOT NULL").select("fp", F.explode(F.array(first)).alias("x")).select("fp", "x.kept", "x.k")

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, kepts = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy().view(np.uint64)
            out: list[list[np.ndarray]] = [[], []]
            for kept in np.unique(kepts):
                own = fps[kepts == kept]
                for mask in masks_beyond(int(kept), radius):
                    out[0].append(own)
                    out[1].append(np.full(len(own), mask, np.uint64))
            fp, mask = (np.concatenate([np.zeros(0, np.uint64), *part]) for part in out)
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (fp, mask, fp & mask)], names=["fp", "kept", "k"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [p for members in batch.column(0) for p in _links_in(members.values.to_numpy(), radius)]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["a", "b"])

    edges = None
    while True:
        sizes = keyed.groupBy("kept", "k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        shared = keyed.join(sizes, ["kept", "k"])
        buckets = shared.filter(F.col("n") <= limit).groupBy("kept", "k").agg(F.array_sort(F.collect_set("fp")).alias("members")).select("members")
        here = buckets.mapInArrow(link, "a long, b long")
        edges = here if edges is None else edges.unionAll(here)
        crowded = materialise(shared.filter(F.col("n") > limit).select("fp", "kept").distinct())
        if crowded.isEmpty():
            return edges.distinct()
        keyed = materialise(crowded.mapInArrow(cover, "fp long, kept long, k long").distinct())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable from each node of the edges, by alternating large and small stars.

    Each round is a few grouped joins over the edges that are left, written to the shared checkpoint folder. Edges may
    repeat, in either direction; those of a node with itself or with null count for nothing, and a table without others
    gives no rows. Nodes are of any ordered type, structs included.
    """
    now = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    if now.isEmpty():
        return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    for _ in range(max_rounds):
        # large star: every larger neighbour is joined to the smallest of the neighbourhood
        both = now.select("a", "b").unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), F.least("a", "m").alias("m"))
        large = both.join(least, both["a"] == least["c"]).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: the same among the smaller neighbours
        least = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), "m")
        joined = large.join(least, large["a"] == least["c"])
        small = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select(F.col("c").alias("a"), F.col("m").alias("b"))).filter("a <> b").distinct()
        after = materialise(small)
        # done when every node has one edge, and no node is both an end and a start
        busy = after.groupBy("a").count().filter("count > 1").select("a").unionAll(after.select("a").intersect(after.select(F.col("b").alias("a"))))
        now = after
        if busy.isEmpty():
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def components_of(rows: DataFrame, radius: int) -> DataFrame:
    """(fp, component_id) of the fingerprints of `rows`, which have doc_id and fp."""
    distinct = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    # fingerprints linked to others, with the root of their component
    rooted = components(links(distinct, radius))
    roots = distinct.join(rooted, distinct["fp"] == rooted["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    return roots.join(smallest, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 2, text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    Fingerprints are the majority bits of XXH64 of word shingles; two link at `radius` or fewer differing bits, and
    component_id is the smallest doc_id reachable. Equal fingerprints are joined to one before anything else, so
    copies never meet in pairs; links are searched among different fingerprints by covering hashing.

    Null and empty texts have fingerprint zero and link like any other. Rows with a null doc_id get a row and the
    smallest doc_id of their component, null if it has none. Repeated rows each get theirs; an empty table gives none.
    Other columns of `docs` are not read.
    """
    rows = materialise(fingerprints(docs, width, text))
    return rows.join(components_of(rows, radius), "fp").select("doc_id", hexed(F.col("fp")).alias("fingerprint"), "component_id")


def similarity(a: bytes, b: bytes, width: int) -> float:
    """Jaccard similarity of two texts' shingles; 1 for two texts without words."""
    if a == b:
        return 1.0
    one, two = (np.unique(shingle_hashes(t, width)) for t in (a, b))
    both = len(np.intersect1d(one, two, assume_unique=True))
    return both / (len(one) + len(two) - both) if len(one) + len(two) else 1.0


def band_keys(parts: Iterable[np.ndarray]) -> np.ndarray:
    """A key for each band of BAND_ROWS smallest hashes; none for a text without shingles.

    Two texts of Jaccard similarity s share the key of a band with probability s ** BAND_ROWS: at 0.8 at least one key
    of 20 in 99.96 % of pairs.
    """
    least, some = np.full(len(FACTORS), np.iinfo(np.uint64).max, np.uint64), False
    for hashes in parts:
        some = some or len(hashes) > 0
        for at in range(0, len(hashes), 1 << 12):
            least = np.minimum(least, ((hashes[None, at : at + (1 << 12)] ^ OFFSETS[:, None]) * FACTORS[:, None]).min(1))
    return np.array([xxhash.xxh64_intdigest(row.tobytes(), i) for i, row in enumerate(least.reshape(BANDS, -1))] if some else [], np.uint64)


def wide_sketch(parts: Iterable[np.ndarray]) -> bytes:
    """The last byte of each of WIDE smallest hashes; none for a text without shingles. Two texts agree in each with the probability
    of their similarity, so their share of agreement is off by at most 1/64 in two of three cases."""
    least, some = np.full(WIDE, np.iinfo(np.uint64).max, np.uint64), False
    for hashes in parts:
        some = some or len(hashes) > 0
        for at in range(0, len(hashes), 1 << 8):
            least = np.minimum(least, ((hashes[None, at : at + (1 << 8)] ^ WIDE_OFFSETS[:, None]) * WIDE_FACTORS[:, None]).min(1))
    return least.astype(np.uint8).tobytes() if some else b""


def sketches(docs: DataFrame, width: int, bands: bool) -> DataFrame:
    """(doc_id, digest, fp, keys) of documents with doc_id, digest and __text: their fingerprint and, with `bands`, keys of bands."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, keys = [], []
            for t in raw_texts(batch.column(2)):
                # a long text is hashed twice rather than held
                hashes = [shingle_hashes(t, width)] if len(t) <= 16 * tb.STEP else None
                fps.append(signed(majority(hashes or shingle_parts(t, width))))
                keys.append(band_keys(hashes or shingle_parts(t, width)).view(np.int64) if bands else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "digest", "fp", "keys"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "digest", "__text").mapInArrow(run, f"doc_id {id_type}, digest binary, fp long, keys array<long>")


def similar(pairs: DataFrame, texts: DataFrame, width: int, least_similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts' shingles are at least so similar; texts: (__id, __text)."""
    first = texts.select(F.col("__id").alias("a"), F.col("__text").alias("__a"))
    second = texts.select(F.col("__id").alias("b"), F.col("__text").alias("__b"))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", "__a", "__b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            like = pa.array([similarity(a, b, width) >= least_similarity for a, b in zip(raw_texts(batch.column(2)), raw_texts(batch.column(3)), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(like), batch.column(1).filter(like)], names=["a", "b"])

    id_type = pairs.schema["a"].dataType.simpleString()
    return both.mapInArrow(run, f"a {id_type}, b {id_type}").distinct()


def ordered(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) of different nodes, once each, the larger first."""
    return pairs.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def agreeing(least_similarity: float) -> int:
    """Of WIDE smallest hashes, how many agree in all but about 1 of 300,000 pairs of texts of that similarity: the mean less 4.5 deviations."""
    return int(WIDE * least_similarity - 4.5 * (WIDE * least_similarity * (1 - least_similarity)) ** 0.5)


def split_buckets(met: DataFrame, group: DataFrame) -> DataFrame:
    """(id, k, next, root, n) of the members of buckets that hold several groups, with their group and the size of their bucket;
    met: (id, k, next, n)."""
    root = group.select(F.col("node").alias("id"), "root")
    known = met.join(root, "id", "left").select("id", "k", "next", "n", F.xxhash64(F.coalesce("root", "id")).alias("root"))
    split = known.groupBy("k").agg(F.min("root").alias("one"), F.max("root").alias("other")).filter("one <> other").select("k")
    return known.join(split, "k", "left_semi")


def wide_sketches(texts: DataFrame, width: int) -> DataFrame:
    """(id, least) of texts (__id, __text): their WIDE smallest hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = [wide_sketch(shingle_parts(t, width)) for t in raw_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(least, pa.binary())], names=["id", "least"])

    return texts.select("__id", "__text").mapInArrow(run, f"id {texts.schema['__id'].dataType.simpleString()}, least binary")


def _whole(batch: pa.RecordBatch) -> list[pa.Array]:
    return [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in batch.columns]


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def apart_in_buckets(members: DataFrame, wide: DataFrame, least_similarity: float) -> DataFrame:
    """Pairs (a, b) of nodes of one bucket of a band that are not in one group yet and whose smallest hashes agree as often as
    such texts' do; members as by `split_buckets`, wide: (id, least).

    A bucket is streamed in the order of its members' next bands, each compared with the NEIGHBOURS before it, where buckets of
    up to that many and one are compared in full; `apart_in_crowded` compares the rest. Pairs that do not agree leave no row.
    A bucket of more than TILE is dealt by a hash to parts of about so many, so that none is streamed by one task.
    """
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    enough = agreeing(least_similarity)
    id_type = members.schema["id"].dataType.simpleString()
    part = F.pmod(F.xxhash64("id", F.lit(3)), F.ceil(F.col("n") / F.lit(TILE))).cast("int")
    dealt = members.join(wide, "id").withColumn("part", part).repartition(n, "k", "part").sortWithinPartitions("k", "part", "next", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for batch in batches:
            rows = _whole(batch)
            now = [pa.concat_arrays([h, r]) for h, r in zip(held, rows, strict=True)] if held else rows
            ids, k, roots, least, parts = now[0], now[1].to_numpy(), now[2].to_numpy(), _matrix(now[3]), now[4].to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (parts[1:] != parts[:-1])]))
            start = starts[np.searchsorted(starts, np.arange(len(k)), side="right") - 1]
            a, b = [], []
            for i in range(len(k) - len(rows[1]), len(k)):
                low = max(int(start[i]), i - NEIGHBOURS)
                if low < i:
                    like = np.flatnonzero((roots[low:i] != roots[i]) & ((least[low:i] == least[i]).sum(1) >= enough)) + low
                    a += [i] * len(like)
                    b += like.tolist()
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(a, pa.int64())), ids.take(pa.array(b, pa.int64()))], names=["a", "b"])
            held = [c.slice(max(len(c) - NEIGHBOURS, 0)) for c in now]

    return ordered(dealt.select("id", "k", "root", "least", "part").mapInArrow(run, f"a {id_type}, b {id_type}"))


def apart_in_crowded(members: DataFrame, wide: DataFrame, least_similarity: float) -> DataFrame:
    """The same pairs, all of them, for buckets of more than NEIGHBOURS and one; members as by `split_buckets`.

    Texts of one group need no comparison, so those outside a bucket's largest group ask, and all texts of the bucket pass them. Askers
    are dealt to blocks of about BLOCK and texts to tiles of about TILE by a hash; a task holds one block and streams one tile. The
    work is the product of askers and texts, which is small where most of a bucket is one group; only pairs that agree leave a row.
    """
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    enough = agreeing(least_similarity)
    id_type = members.schema["id"].dataType.simpleString()
    sizes = members.groupBy("k", "root").agg(F.count(F.lit(1)).alias("c"))
    shape = sizes.groupBy("k").agg(F.max_by("root", F.struct("c", "root")).alias("main"), F.sum("c").alias("texts"), F.max("c").alias("c"))
    count = lambda of, size: F.ceil(of / F.lit(size)).cast("int")
    shape = shape.select("k", "main", count(F.col("texts") - F.col("c"), BLOCK).alias("blocks"), count(F.col("texts"), TILE).alias("tiles"))
    block, tile = (F.pmod(F.xxhash64("id", F.lit(seed)), F.col(of)).cast("int") for seed, of in ((1, "blocks"), (2, "tiles")))
    asked = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(block.alias("block"), t.alias("tile"), F.lit(True).alias("asks")))
    passed = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.struct(b.alias("block"), tile.alias("tile"), F.lit(False).alias("asks")))
    cells = F.explode(F.when(F.col("root") != F.col("main"), F.concat(asked, passed)).otherwise(passed))
    placed = members.join(shape, "k").select("id", "k", "root", cells.alias("cell")).select("id", "k", "root", "cell.*").join(wide, "id")
    dealt = placed.repartition(n, "k", "block", "tile").sortWithinPartitions("k", "block", "tile", F.desc("asks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, askers, matrix = None, [], None
        for batch in batches:
            ids, k, roots, blocks, tiles, asks, least = _whole(batch)
            sketch, k, roots, asks = _matrix(least), k.to_numpy(), roots.to_numpy(), asks.to_numpy(zero_copy_only=False)
            keys = np.stack([k, blocks.to_numpy().astype(np.int64), tiles.to_numpy().astype(np.int64)], 1)
            a, b = [], []
            for i in range(len(k)):
                if cell is None or (keys[i] != cell).any():
                    cell, askers, matrix = keys[i], [], None
                if asks[i]:
                    askers.append((ids[i].as_py(), roots[i], sketch[i]))
                elif askers:
                    if matrix is None:
                        matrix = np.stack([x[2] for x in askers]), np.array([x[1] for x in askers])
                    like = np.flatnonzero((matrix[1] != roots[i]) & ((matrix[0] == sketch[i]).sum(1) >= enough))
                    a += [i] * len(like)
                    b += [askers[j][0] for j in like]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(a, pa.int64())), pa.array(b, ids.type)], names=["a", "b"])

    return ordered(dealt.select("id", "k", "root", "block", "tile", "asks", "least").mapInArrow(run, f"a {id_type}, b {id_type}"))


def keep_one(docs: DataFrame, width: int = 5, radius: int = 5, least_similarity: float = 0.8, text: str = "text", bands: bool = False) -> DataFrame:
    """The rows of `docs` with all columns, one document of each group of near duplicates: that of the smallest doc_id.

    Groups are the components of pairs of texts whose shingles are at least `least_similarity` like each other. Equal texts
    are joined to one before anything else. Pairs are proposed by fingerprints within `radius` bits and each is checked on
    the texts. Fingerprints alone miss most pairs of 0.8; with `bands`, texts that share the key of a band are proposed too:
    first every text with the smallest of its buckets, then all pairs of a bucket that are not yet in one group and whose
    smallest hashes agree as often as those of such texts: near ones in the order of their next band, and, where a larger
    bucket then still holds several groups, all.

    A document is a doc_id with a text: rows that repeat both are one and one row stays; rows of one doc_id with unlike
    texts all stay. Null and empty texts have no shingles and are equal. Rows with a null doc_id cannot stand for a group and
    all stay; an empty table gives none. Columns of any name pass through.
    """
    digest = F.substring(F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)), 1, 16)
    rows = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", digest.alias("digest"), F.coalesce(F.col(text), F.lit("")).alias("__text"), F.struct("*").alias("__row"))
    sketched = materialise(sketches(rows, width, bands).groupBy("doc_id", "digest").agg(*(F.first(c).alias(c) for c in ("fp", "keys"))))
    # a node for each different text: the smallest doc_id that has it, and its digest
    own = materialise(sketched.groupBy("digest").agg(F.min("doc_id").alias("d"), *(F.first(c).alias(c) for c in ("fp", "keys"))).select(F.struct("d", "digest").alias("id"), "fp", "keys"))

    # texts by their fingerprints: each with the first of its own, and the first of linked ones
    heads = materialise(own.groupBy("fp").agg(F.min("id").alias("first")))
    equal = own.join(heads, "fp").select(F.col("id").alias("a"), F.col("first").alias("b"))
    left, right = heads.select(F.col("fp").alias("a"), F.col("first").alias("__a")), heads.select(F.col("fp").alias("b"), F.col("first").alias("__b"))
    linked = links(heads, radius).join(left, "a").join(right, "b").select(F.col("__a").alias("a"), F.col("__b").alias("b"))
    # texts by bands, each with the first of its bucket
    keyed = own.select("id", F.posexplode("keys").alias("i", "k"), F.expr("keys[(i + 1) % size(keys)]").alias("next"))
    buckets = keyed.groupBy("k").agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = materialise(keyed.join(buckets, "k").select("id", "k", "next", "n", "head"))

    def texts_of(nodes: DataFrame) -> DataFrame:
        asked = nodes.select(F.col("id.d").alias("doc_id"), F.col("id.digest").alias("digest"))
        found = rows.select("doc_id", "digest", "__text").join(asked, ["doc_id", "digest"], "left_semi").dropDuplicates(["doc_id", "digest"])
        return found.select(F.struct(F.col("doc_id").alias("d"), "digest").alias("__id"), "__text")

    def alike(pairs: DataFrame) -> DataFrame:
        nodes = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).distinct()
        return similar(pairs, materialise(texts_of(nodes)), width, least_similarity)

    def joined(group: DataFrame, pairs: DataFrame) -> DataFrame:
        """The groups, joined where the texts of a pair are alike."""
        roots = group.select(F.col("node").alias("a"), F.col("root").alias("b"))
        return group if pairs.isEmpty() else components(roots.unionAll(alike(pairs)))

    tried = materialise(ordered(equal.unionAll(linked).unionAll(met.select(F.col("id").alias("a"), F.col("head").alias("b")))))
    group = components(alike(tried))
    members = materialise(split_buckets(met, group))
    if not members.isEmpty():
        wide = materialise(wide_sketches(texts_of(members.select("id").distinct()), width))
        apart = materialise(apart_in_buckets(members, wide, least_similarity).join(tried, ["a", "b"], "left_anti"))
        group = joined(group, apart)
        crowded = materialise(split_buckets(met.filter(F.col("n") > NEIGHBOURS + 1), group))
        if not crowded.isEmpty():
            rest = apart_in_crowded(crowded, wide, least_similarity).join(tried.unionAll(apart), ["a", "b"], "left_anti")
            group = joined(group, materialise(rest))

    # of each digest its node stays, unless that belongs to another
    gone = group.select(F.col("node.d").alias("d"), F.col("node.digest").alias("digest"))
    stay = own.select("id.d", "id.digest").join(gone, ["d", "digest"], "left_anti").select(F.col("d").alias("doc_id"), "digest")
    once = Window.partitionBy("doc_id", "digest").orderBy(F.lit(1))
    kept = rows.select("doc_id", "digest", "__row").join(stay, ["doc_id", "digest"], "left_semi").withColumn("__n", F.row_number().over(once)).filter("__n = 1").select("__row.*")
    return kept.unionByName(docs.filter(F.col("doc_id").isNull()))


def hexed(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
