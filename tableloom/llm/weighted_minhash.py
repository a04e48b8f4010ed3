"""Near duplicates by improved consistent weighted sampling over word shingles.

A text is the weighted set of its five-word shingles: occurrences times a damped
inverse document frequency. Document frequencies of all texts are counted in a
table of fixed width, addressed by the hash of a shingle; the mean count of a
cell, which other shingles cause, is taken off. Consistent weighted samples
agree with the probability of the weighted Jaccard similarity; three samples
make a band, and texts sharing two bands are candidates: of two texts as similar
as 0.8, 99.7 % share two. Candidates are compared themselves, and links of
enough similarity make the classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.functions.columns import column
from tableloom.llm.components import components
from tableloom.llm.tables import texts
from tableloom.llm.words import in_pieces, words_of
from tableloom.session import cut_lineage

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 12, 3
#: Cells of the table of document frequencies: a fixed bound, whatever the input.
CELL_BITS = 18
#: Share by which a shingle in one document outweighs one that all documents have.
IDF_SHARE = 0.2
#: Rounds in which texts outside the largest class meet a member of it.
STAR_ROUNDS = 1
#: Texts, and weight of their shingles, that a task holds to compare others with, about.
HELD_TEXTS, HELD_WEIGHT = 256, 500_000
#: Places at once where shingles of given texts meet those of held ones.
MEETINGS = 1 << 20
#: Bits of the map that tells most texts alone from those that share bands: a fixed bound.
MAP_BITS = 26
#: Texts that pass by what a task holds, about.
STRIPE = 2_048
#: Keys that a task remembers to drop copies.
REMEMBERED_KEYS = 500_000
#: Shingles sampled at once, few enough for the cache of a core.
SLICE = 1 << 14

FACTORS = np.array([xxhash.xxh64_intdigest(bytes([k])) | 1 for k in range(SHINGLE)], np.uint64)
SEEDS = np.array([xxhash.xxh64_intdigest(b"s%d" % k) for k in range(BANDS * ROWS)], np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers; constants of the splitmix64 generator."""
    made = values + np.uint64(0x9E3779B97F4A7C15)
    made = (made ^ (made >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    made = (made ^ (made >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return made ^ (made >> np.uint64(31))


@dataclass(frozen=True)
class Shingles:
    """Distinct shingles of a batch of texts, sorted within each, and their occurrences."""

    hashes: np.ndarray
    occurrences: np.ndarray
    bounds: np.ndarray

    def of(self, text: int) -> tuple[np.ndarray, np.ndarray]:
        held = slice(self.bounds[text], self.bounds[text + 1])
        return self.hashes[held], self.occurrences[held]


def shingles_of(batch: pa.Array) -> Shingles:
    """Shingles of lower-cased words; a text of one to four words is one shingle."""
    words = words_of(pc.utf8_lower(batch))
    known = np.array([xxhash.xxh64_intdigest(w) for w in words.listed], np.uint64)
    hashed = known[words.codes]
    n = max(len(hashed) - SHINGLE + 1, 0)
    sums = np.zeros(n, np.uint64)
    for k, factor in enumerate(FACTORS):
        sums += hashed[k : k + n] * factor
    sums = mixed(sums)
    parts, counts, sizes = [], [], []
    for begin, end in zip(words.bounds, words.bounds[1:], strict=False):
        if end - begin >= SHINGLE:
            found, often = np.unique(sums[begin : end - SHINGLE + 1], return_counts=True)
        else:
            short = hashed[begin:end]
            found = mixed((short * FACTORS[: len(short)]).sum(keepdims=True))[: len(short)]
            often = np.ones(len(found), np.int64)
        parts.append(found)
        counts.append(often)
        sizes.append(len(found))
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    if not parts:
        return Shingles(np.zeros(0, np.uint64), np.zeros(0, np.int64), bounds)
    return Shingles(np.concatenate(parts), np.concatenate(counts), bounds)


def cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def idf_factors(counts: np.ndarray, n_texts: int) -> np.ndarray:
    """Weight of each cell: 1 if all texts have it, ``1 + IDF_SHARE`` if one has."""
    frequency = np.clip(counts - counts.mean(), 1, max(n_texts, 1))
    rarity = np.log(max(n_texts, 1) / frequency) / np.log(max(n_texts, 2))
    return (1 + IDF_SHARE * rarity).astype(np.float32)


def cell_counts(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Texts having a shingle of each cell, and the number of texts.

    At most one row per cell reaches the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, rows = np.zeros(1 << CELL_BITS, np.int64), 0
        for batch in in_pieces(batches, "text"):
            found = shingles_of(batch.column("text"))
            totals += np.bincount(cells(found.hashes), minlength=len(totals))
            rows += batch.num_rows
        places = np.flatnonzero(totals)
        yield pa.RecordBatch.from_pydict(
            {
                "cell": pa.array(np.concatenate([[-1], places]), pa.int32()),
                "n": pa.array(np.concatenate([[rows], totals[places]]), pa.int64()),
            }
        )

    counted = docs.select("text").mapInArrow(count, "cell int, n long")
    rows = counted.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    totals = np.zeros((1 << CELL_BITS) + 1, np.int64)
    totals[rows["cell"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.int64)
    return totals[:-1], int(totals[-1])


def spread(values: np.ndarray) -> np.ndarray:
    """A cheaper ``mixed`` for numbers that are hashes already."""
    made = values * np.uint64(0xBF58476D1CE4E5B9)
    made ^= made >> np.uint64(32)
    made *= np.uint64(0x94D049BB133111EB)
    made ^= made >> np.uint64(29)
    return made


def samples(hashes: np.ndarray, log_weights: np.ndarray, seed: np.uint64) -> tuple:
    """For each shingle its logarithmic sampling value and its quantised weight level.

    The gamma variables ``r`` and ``c`` are each the negative logarithm of the product
    of two uniform 16-bit numbers, ``beta`` is a uniform 24-bit number.
    """
    drawn = spread(hashes ^ seed)
    uniform = drawn.view("<u2").reshape(-1, 4).astype(np.float32)
    uniform += np.float32(0.5)
    uniform *= np.float32(2**-16)
    gamma = -np.log(uniform[:, ::2] * uniform[:, 1::2])
    r, c = gamma[:, 0], gamma[:, 1]
    drawn *= np.uint64(0xD6E8FEB86659FD93)
    beta = (drawn >> np.uint64(40)).astype(np.float32) * np.float32(2**-24)
    level = np.floor(log_weights / r + beta)
    return np.log(c) - r * (level - beta + np.float32(1)), level


def band_hashes(found: Shingles, factors: np.ndarray) -> np.ndarray:
    """``BANDS`` numbers for every text that has shingles; zeros for the others."""
    n = len(found.bounds) - 1
    bands = np.zeros((n, BANDS), np.uint64)
    filled = np.flatnonzero(np.diff(found.bounds))
    if not len(filled):
        return bands
    starts = found.bounds[filled]
    sizes = np.diff(found.bounds)[filled]
    weights = np.log(found.occurrences * factors[cells(found.hashes)]).astype(np.float32)
    owners = np.repeat(np.arange(len(filled)), sizes)
    values = np.empty(len(weights), np.float32)
    levels = np.empty(len(weights), np.float32)
    for j, seed in enumerate(SEEDS):
        for a in range(0, len(weights), SLICE):
            b = a + SLICE
            values[a:b], levels[a:b] = samples(found.hashes[a:b], weights[a:b], seed)
        lowest = np.minimum.reduceat(values, starts)
        hits = np.flatnonzero(values == np.repeat(lowest, sizes))
        _, first = np.unique(owners[hits], return_index=True)
        picked = hits[first]
        drawn = mixed(found.hashes[picked] ^ levels[picked].astype(np.int64).view(np.uint64))
        bands[filled, j // ROWS] = mixed(bands[filled, j // ROWS] ^ drawn ^ SEEDS[j // ROWS])
    return bands


def signatures(docs: DataFrame, factors: np.ndarray) -> DataFrame:
    """``doc_id``, ``key`` of the exact text, ``bands`` (empty without words), total ``weight``."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "text"):
            found = shingles_of(batch.column("text"))
            bands = band_hashes(found, factors).view(np.int64)
            empty = np.diff(found.bounds) == 0
            listed = [[] if none else row for none, row in zip(empty, bands, strict=True)]
            each = found.occurrences * factors[cells(found.hashes)].astype(np.float64)
            sums = np.concatenate([[0.0], np.cumsum(each)])[found.bounds]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "key": batch.column("key"),
                    "bands": pa.array(listed, pa.list_(pa.int64())),
                    "weight": np.diff(sums),
                }
            )

    return docs.mapInArrow(sign, "doc_id long, key string, bands array<long>, weight double")


def similarity(
    a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], factors: np.ndarray
) -> float:
    """Weighted Jaccard similarity of two sets of (shingles, occurrences)."""
    weight_a, weight_b = (n * factors[cells(h)].astype(np.float64) for h, n in (a, b))
    _, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(weight_a[at_a], weight_b[at_b]).sum()
    total = weight_a.sum() + weight_b.sum() - shared
    return float(shared / total) if total else 1.0


class Held:
    """Texts that a task keeps, to be compared with many others."""

    def __init__(self, keys: list[str], found: Shingles, factors: np.ndarray):
        order = np.argsort(found.hashes, kind="stable")
        sizes = np.diff(found.bounds)
        weights = found.occurrences * factors[cells(found.hashes)].astype(np.float64)
        self.keys = np.array(keys, dtype=object)
        self.hashes = found.hashes[order]
        self.owners = np.repeat(np.arange(len(keys)), sizes)[order]
        self.weights = weights[order]
        self.totals = np.bincount(np.repeat(np.arange(len(keys)), sizes), weights, len(keys))

    def linked(
        self, keys: list[str], found: Shingles, factors: np.ndarray, least: float
    ) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a held key and a given one whose texts are similar enough."""
        weights = found.occurrences * factors[cells(found.hashes)].astype(np.float64)
        begins = np.searchsorted(self.hashes, found.hashes)
        often = np.searchsorted(self.hashes, found.hashes, "right") - begins
        # few given texts at a time, by the places where their shingles meet held ones
        met = np.concatenate([[0], np.cumsum(often)])[found.bounds]
        cuts = np.flatnonzero(np.diff(met[1:] // MEETINGS, prepend=-1)).tolist()
        names = np.array(keys, dtype=object)
        pairs = []
        for first, last in zip(cuts, [*cuts[1:], len(keys)], strict=True):
            own = slice(found.bounds[first], found.bounds[last])
            rows = np.repeat(np.arange(last - first), np.diff(found.bounds[first : last + 1]))
            near = self._near(rows, weights[own], begins[own], often[own], last - first, least)
            pairs.append((near[1], near[0] + first))
        a = np.concatenate([p[0] for p in pairs]) if pairs else np.zeros(0, int)
        b = np.concatenate([p[1] for p in pairs]) if pairs else np.zeros(0, int)
        apart = self.keys[a] != names[b]
        return a[apart], b[apart]

    def _near(self, rows, weights, begins, often, n: int, least: float) -> tuple:
        """Rows and held texts that are similar enough, from the places of the rows' shingles."""
        k = len(self.keys)
        totals = np.bincount(rows, weights, n)
        given = np.repeat(np.arange(len(often)), often)
        at = np.repeat(begins - np.cumsum(often) + often, often) + np.arange(often.sum())
        both = np.minimum(weights[given], self.weights[at])
        shared = np.bincount(rows[given] * k + self.owners[at], both, n * k).reshape(n, k)
        either = totals[:, None] + self.totals - shared
        return np.nonzero((shared >= least * either) & (either > 0))


def linked(cell_rows: DataFrame, contents: DataFrame, factors: np.ndarray, least: float) -> DataFrame:
    """Links ``a``, ``b`` between the held and the other texts of each cell.

    ``cell_rows`` has ``cell``, ``key`` and whether the key is ``held``. A cell holds
    a bounded number of texts; the others pass by, so a text moves once for each of
    its cells and not for each of its pairs.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, waiting, held = None, [], None
        for batch in in_pieces(batches, "text"):
            cells_ = batch.column("cell").to_numpy()
            is_held = batch.column("held").to_numpy(zero_copy_only=False)
            change = np.flatnonzero((np.diff(cells_) != 0) | (np.diff(is_held.astype(int)) != 0)) + 1
            for begin, end in zip([0, *change], [*change, batch.num_rows], strict=True):
                part = batch.slice(begin, end - begin)
                if cells_[begin] != cell:
                    cell, waiting, held = cells_[begin], [], None
                if is_held[begin]:
                    waiting.append(part.select(["key", "text"]))
                    continue
                if not waiting:
                    continue
                if held is None:
                    table = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                    found = shingles_of(table.column("text"))
                    held = Held(table.column("key").to_pylist(), found, factors)
                keys = part.column("key").to_pylist()
                a, b = held.linked(keys, shingles_of(part.column("text")), factors, least)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(held.keys[a].tolist(), pa.string()), part.column("key").take(pa.array(b))],
                    ["a", "b"],
                )

    dealt = (
        cell_rows.join(contents, "key")
        .select("cell", "held", "key", "text")
        .repartition("cell")
        .sortWithinPartitions("cell", F.desc("held"))
    )
    return dealt.mapInArrow(compare, "a string, b string")


def merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """Classes (``key``, ``class``) after joining those that the links connect.

    Only keys outside their own class's root need a row; others are their own class.
    """
    old = classes.select(F.col("key").alias("k"), F.col("class").alias("c"))
    ends = links
    for end in ("a", "b"):
        ends = (
            ends.join(old, F.col(end) == F.col("k"), "left")
            .withColumn(end, F.coalesce("c", end))
            .drop("k", "c")
        )
    roots = components(ends)
    moved = old.join(roots, F.col("c") == F.col("node"), "left").select(
        F.col("k").alias("key"), F.coalesce("root", "c").alias("class")
    )
    new = roots.select(F.col("node").alias("key"), F.col("root").alias("class"))
    added = new.join(old, F.col("key") == F.col("k"), "left_anti")
    return cut_lineage(moved.union(added))


def shared_buckets(spread: DataFrame) -> DataFrame:
    """Rows ``bucket``, ``key`` whose bucket holds two texts or more."""
    written = cut_lineage(spread)
    shared = written.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    return written.join(cut_lineage(shared.select("bucket")), "bucket", "left_semi")


def band_members(nodes: DataFrame) -> DataFrame:
    """``bucket``, ``key`` and ``crowd`` of the texts that share a band.

    The crowd of a text are the members of all its bands. It is largest for texts in
    the middle of a group, whose bands most others share.
    """
    alone = shared_buckets(nodes.select(F.explode("bands").alias("bucket"), "key"))
    sizes = alone.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    crowds = alone.join(sizes, "bucket").groupBy("key").agg(F.sum("n").alias("crowd"))
    return cut_lineage(alone.join(crowds, "key").select("bucket", "key", "crowd"))


def bucket_members(bands: DataFrame) -> DataFrame:
    """``bucket``, ``key``, ``crowd`` of the texts that share a pair of bands.

    A text has at most ``BANDS`` bands that others share, so its list is short.
    """
    listed = bands.groupBy("key", "crowd").agg(
        F.array_sort(F.collect_list("bucket")).alias("own")
    )
    pairs = F.transform(
        "own", lambda x, i: F.transform(F.slice("own", i + 2, BANDS), lambda y: F.xxhash64(x, y))
    )
    both = listed.select(F.explode(F.flatten(pairs)).alias("bucket"), "key", "crowd")
    return cut_lineage(shared_buckets(both))


def first_hubs(members: DataFrame) -> DataFrame:
    """Every text ``key`` with one other, ``hub``: the most crowded of all its buckets."""
    best = F.max(F.struct("crowd", "key"))
    hubs = cut_lineage(members.groupBy("bucket").agg(best.alias("hub")))
    return (
        members.join(hubs, "bucket")
        .groupBy("key")
        .agg(F.max("hub").alias("hub"))
        .select("key", F.col("hub.key").alias("hub"))
        .where("key <> hub")
    )


def open_members(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Members with their class, of buckets that hold several classes."""
    known = classes.withColumnRenamed("key", "k")
    held = cut_lineage(
        members.join(known, F.col("key") == F.col("k"), "left").select(
            *members.columns, F.coalesce("class", "key").alias("class")
        )
    )
    several = (
        held.groupBy("bucket")
        .agg(F.min("class").alias("lo"), F.max("class").alias("hi"))
        .where("lo < hi")
    )
    return cut_lineage(held.join(cut_lineage(several.select("bucket")), "bucket", "left_semi"))


def main_classes(held: DataFrame, seed: int) -> DataFrame:
    """Of each bucket its largest class, ``main``, and one member of it, ``rep``."""
    order = F.xxhash64("key", F.lit(seed))
    per_class = held.groupBy("bucket", "class").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct(order, "key")).alias("rep")
    )
    return cut_lineage(
        per_class.groupBy("bucket")
        .agg(F.max(F.struct("n", "class", "rep.key")).alias("main"))
        .select("bucket", F.col("main.class").alias("main"), F.col("main.key").alias("rep"))
    )


def further_hubs(held: DataFrame, seed: int) -> DataFrame:
    """Texts outside the largest class of a bucket with a member of that class."""
    order = F.xxhash64("rep", F.lit(seed))
    return (
        held.join(main_classes(held, seed), "bucket")
        .where("class <> main")
        .groupBy("key")
        .agg(F.max(F.struct(order, "rep")).alias("hub"))
        .select("key", F.col("hub.rep").alias("hub"))
    )


def every(count: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), count - 1))


def hub_cells(pairs: DataFrame) -> DataFrame:
    """Cells of one hub and some of the texts that it is to be compared with."""
    written = cut_lineage(pairs)
    sizes = written.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / STRIPE).alias("stripes"))
    stripe = F.pmod(F.xxhash64("key"), F.col("stripes"))
    others = written.join(sizes, "hub").select(
        F.xxhash64("hub", stripe).alias("cell"), "key", F.lit(False).alias("held")
    )
    hubs = sizes.select("hub", every(F.col("stripes")).alias("stripe")).select(
        F.xxhash64("hub", "stripe").alias("cell"), F.col("hub").alias("key"), F.lit(True).alias("held")
    )
    return others.unionAll(hubs)


def block_cells(held: DataFrame) -> DataFrame:
    """Cells that meet every text outside its bucket's largest class with all texts of the bucket.

    The former are dealt to chunks that a task can hold, by number and weight, the
    latter to stripes, and each chunk meets each stripe.
    """
    main = main_classes(held, 0).drop("rep")
    placed = cut_lineage(held.join(main, "bucket").withColumn("small", F.col("class") != F.col("main")))
    small_weight = F.sum(F.when(F.col("small"), F.col("weight")).otherwise(0))
    sizes = placed.groupBy("bucket").agg(
        F.ceil(
            F.greatest(F.count_if("small") / HELD_TEXTS, small_weight / HELD_WEIGHT)
        ).alias("chunks"),
        F.ceil(F.count(F.lit(1)) / STRIPE).alias("stripes"),
    )
    sized = cut_lineage(placed.join(sizes, "bucket").select("bucket", "key", "small", "chunks", "stripes"))
    chunk = F.pmod(F.xxhash64("key", F.lit(1)), F.col("chunks"))
    stripe = F.pmod(F.xxhash64("key"), F.col("stripes"))
    cell = F.xxhash64("bucket", "chunk", "stripe").alias("cell")
    kept = sized.where("small").select(
        "bucket", "key", chunk.alias("chunk"), every(F.col("stripes")).alias("stripe")
    )
    others = sized.select(
        "bucket", "key", every(F.col("chunks")).alias("chunk"), stripe.alias("stripe")
    )
    return kept.select(cell, "key", F.lit(True).alias("held")).unionAll(
        others.select(cell, "key", F.lit(False).alias("held"))
    )


def place_in_map(key: Column) -> Column:
    return F.xxhash64(key).bitwiseAND((1 << MAP_BITS) - 1)


def key_map(keys: DataFrame) -> np.ndarray:
    """Words of 64 bits, a bit set for every key; at most one row per word is collected."""
    placed = keys.select(place_in_map(F.col("key")).alias("place"))
    words = placed.groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place & 63 AS int))")).alias("bits")
    )
    found = words.toPandas()
    made = np.zeros(1 << (MAP_BITS - 6), np.int64)
    made[found["word"].to_numpy(dtype=np.int64)] = found["bits"].to_numpy(dtype=np.int64)
    return made.view(np.uint64)


def contents_of(rows: DataFrame, involved: DataFrame) -> DataFrame:
    """One row ``key``, ``text`` of every involved key.

    Texts whose keys the map leaves out and copies met before by the same task stay
    where they are; the others are shuffled. A map that is too full only spares less.
    """
    spark = rows.sparkSession
    known = spark.sparkContext.broadcast(key_map(involved))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[str] = set()
        for batch in batches:
            place = batch.column("place").to_numpy().astype(np.uint64)
            bits = known.value[place >> np.uint64(6)] >> (place & np.uint64(63))
            kept = (bits & np.uint64(1)).astype(bool)
            keys = batch.column("key").to_pylist()
            for i in np.flatnonzero(kept).tolist():
                kept[i] = keys[i] not in met
                met.add(keys[i])
            if len(met) > REMEMBERED_KEYS:
                met = set()
            yield batch.select(["key", "text"]).filter(pa.array(kept))

    placed = rows.select("key", "text", place_in_map(F.col("key")).alias("place"))
    few = placed.mapInArrow(first, "key string, text string")
    return few.join(involved, "key", "left_semi").dropDuplicates(["key"])


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and the ``key`` of the exact text; null is the empty text."""
    rows = texts(docs, "doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    return rows.select(F.col("doc_id").cast("long"), text.alias("text"), F.md5(text).alias("key"))


@dataclass(frozen=True)
class Classes:
    """``rows``: doc_id, key; ``keys``: key, class_id, class_size, first_key."""

    rows: DataFrame
    keys: DataFrame


def near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> Classes:
    """Classes of texts connected by links of at least the similarity ``least``.

    Equal texts, null counting as empty, are one node; texts without words
    are linked to nothing but their equals. Rows with repeated or null
    ``doc_id`` keep their own rows. ``class_id`` is the smallest ``doc_id`` of a
    class. Other columns are not read.

    Each text first meets the most crowded text that shares a pair of bands with it.
    Then texts outside the largest class of a bucket meet some member of that class. This joins most of a group at a price of one comparison
    a text and round. What is still apart, though it shares a pair of bands, is
    compared completely, in blocks: every text outside the largest class of a band
    with all texts of that band.
    """
    rows = keyed(docs)
    counts, n_texts = cell_counts(rows)
    factors = idf_factors(counts, n_texts)
    signed = cut_lineage(signatures(rows, factors))
    nodes = cut_lineage(
        signed.groupBy("key").agg(
            F.min("doc_id").alias("first_id"),
            F.count("*").alias("copies"),
            F.first("bands").alias("bands"),
            F.min("weight").alias("weight"),
        )
    )
    bands = band_members(nodes)
    members = bucket_members(bands)
    involved = cut_lineage(members.select("key").distinct())
    contents = cut_lineage(contents_of(rows, involved))
    classes = docs.sparkSession.createDataFrame([], "key string, class string")

    def joined(cell_rows: DataFrame) -> DataFrame:
        links = cut_lineage(linked(cell_rows, contents, factors, least))
        return classes if links.isEmpty() else merged(classes, links)

    classes = joined(hub_cells(first_hubs(members)))
    for seed in range(STAR_ROUNDS):
        classes = joined(hub_cells(further_hubs(open_members(members, classes), seed)))
    apart = open_members(members, classes).select("key").distinct()
    near = bands.drop("crowd").join(cut_lineage(apart), "key", "left_semi")
    weighed = near.join(nodes.select("key", "weight"), "key")
    classes = joined(block_cells(open_members(weighed, classes)))
    known = classes.withColumnRenamed("key", "k")
    grouped = cut_lineage(
        nodes.drop("bands", "weight")
        .join(known, F.col("key") == F.col("k"), "left")
        .select("key", "first_id", "copies", F.coalesce("class", "key").alias("class"))
    )
    chosen = F.min(F.struct(F.col("first_id").isNull().alias("none"), "first_id", "key"))
    summed = grouped.groupBy("class").agg(
        chosen.alias("chosen"), F.sum("copies").alias("class_size")
    )
    keys = grouped.join(cut_lineage(summed), "class").select(
        "key",
        F.col("chosen.first_id").alias("class_id"),
        "class_size",
        F.col("chosen.key").alias("first_key"),
    )
    return Classes(signed.select("doc_id", "key"), cut_lineage(keys))


def class_rows(found: Classes) -> DataFrame:
    """One row per document: ``doc_id``, ``class_id``, ``class_size``."""
    return found.rows.join(found.keys, "key").select("doc_id", "class_id", "class_size")


def one_of_each(docs: DataFrame, found: Classes) -> DataFrame:
    """One whole row of each class, that of its ``class_id``; columns as in ``docs``."""
    kept = found.keys.where("key = first_key").select(
        F.col("key").alias("_kept"), F.col("class_id").alias("_class")
    )
    rows = docs.select(
        F.struct(*docs.columns).alias("_row"),
        column("doc_id").cast("long").alias("_id"),
        F.md5(F.coalesce(column("text"), F.lit(""))).alias("_key"),
    )
    same = (F.col("_key") == F.col("_kept")) & F.col("_id").eqNullSafe(F.col("_class"))
    single = rows.dropDuplicates(["_key", "_id"])
    return single.join(kept, same, "left_semi").select("_row.*")
