"""Exact ranked lexical search by norm buckets.

A document is a vector of integer impacts over the terms of the asked items; an
item is a vector of term weights, so a score is an inner product. Documents lie
in the order of their vectors' lengths, in buckets. For each item,

* Cauchy-Schwarz leaves out the buckets whose longest vector times the item's
  length cannot reach the ``k``-th best score known so far;
* inside a bucket, coordinates are met by falling weight of the item. A document
  can gain no more from the coordinates not met than the product of what is left
  of both lengths, and goes when that bound falls below the ``k``-th best score;
* the documents left are scored in 64-bit integers.

Items are taken in blocks of bounded text, so that the terms of a block can be
sent to every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableloom.functions.columns import column
from tableloom.llm.tables import partitions, whole
from tableloom.llm.words import in_pieces
from tableloom.session import cut_lineage

#: An item block ends after so many bytes of text or items.
BLOCK_BYTES = 1 << 20
BLOCK_ITEMS = 1000
#: Documents of a bucket, and the longest ones that give the first thresholds.
BUCKET_ROWS = 1024
SEED_ROWS = 2048
#: Shares of an item's coordinates after which documents are left out.
CHECKPOINTS = (0.15, 0.3, 0.5, 0.75, 1.0)
#: Bounds are doubles of sums and roots; they are raised by this factor.
MARGIN = 1 + 1e-9
#: Weights and impacts of the ranking formula, fixed by its contract.
WEIGHT_SCALE, IMPACT_SCALE, TERM_SCALE = 1000, 1_000_000_000, 1000
LENGTH_SHARE, LENGTH_WEIGHT = 75, 8

COUNTED = "doc_id long, n long, terms array<int>, counts array<long>, stats boolean"
FOUND = "query int, doc_id long, score long"


def _byte_table() -> np.ndarray:
    """Each byte of a term lower-cased in A-Z, any other byte as a blank."""
    made = np.arange(256, dtype=np.uint8)
    kept = np.zeros(256, bool)
    kept[ord("0") : ord("9") + 1] = kept[ord("a") : ord("z") + 1] = kept[128:] = True
    upper = np.arange(ord("A"), ord("Z") + 1)
    made[~kept] = ord(" ")
    made[upper] = upper + 32
    return made


BYTES = _byte_table()


@dataclass(frozen=True)
class Terms:
    """Terms of texts in order as codes of ``listed``; text ``i`` owns ``bounds[i]:bounds[i+1]``."""

    codes: np.ndarray
    bounds: np.ndarray
    listed: pa.Array


def terms_of(texts: pa.Array) -> Terms:
    """Maximal runs of ASCII letters and digits and of all other characters above ASCII.

    All separators are single bytes that occur in no longer character, so the
    cut is made on bytes.
    """
    texts = pc.fill_null(texts.cast(pa.string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset :][: len(texts) + 1]
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    begin, end = (int(offsets[0]), int(offsets[-1])) if len(texts) else (0, 0)
    plain = pa.StringArray.from_buffers(
        len(texts),
        pa.py_buffer((offsets - begin).astype(np.int32)),
        pa.py_buffer(BYTES[flat[begin:end]]),
    )
    parts = pc.ascii_split_whitespace(plain)
    coded = parts.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy())]).astype(int)
    blank = pc.index(coded.dictionary, "").as_py()
    if blank >= 0:
        kept = codes != blank
        bounds = np.concatenate([[0], np.cumsum(kept)])[bounds]
        codes = codes[kept]
    return Terms(codes, bounds, coded.dictionary)


def _count_terms(vocabulary: pa.Array):
    """Per document with a term: its terms' number, and counts of those of the vocabulary.

    The last row of a task counts the documents that hold each term.
    """
    size = len(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holders = np.zeros(size, np.int64)
        for batch in in_pieces(batches, "text"):
            terms = terms_of(batch.column("text"))
            lengths = np.diff(terms.bounds)
            known = pc.fill_null(pc.index_in(terms.listed, vocabulary), -1).to_numpy()
            ids = known[terms.codes] if len(terms.codes) else terms.codes
            owners = np.repeat(np.arange(len(lengths)), lengths)[ids >= 0]
            pairs, counts = np.unique(owners * max(size, 1) + ids[ids >= 0], return_counts=True)
            owners, ids = np.divmod(pairs, max(size, 1))
            holders += np.bincount(ids, minlength=size)
            ends = np.searchsorted(owners, np.arange(len(lengths) + 1)).astype(np.int32)
            made = pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64())),
                    pa.array(np.zeros(len(lengths), bool)),
                ],
                ["doc_id", "n", "terms", "counts", "stats"],
            )
            yield made.filter(pa.array(lengths > 0))
        held = np.flatnonzero(holders)
        yield pa.RecordBatch.from_pylist(
            [
                {
                    "doc_id": None,
                    "n": 0,
                    "terms": held.tolist(),
                    "counts": holders[held].tolist(),
                    "stats": True,
                }
            ],
            pa.schema(
                [
                    ("doc_id", pa.int64()),
                    ("n", pa.int64()),
                    ("terms", pa.list_(pa.int32())),
                    ("counts", pa.list_(pa.int64())),
                    ("stats", pa.bool_()),
                ]
            ),
        )

    return run


@dataclass(frozen=True)
class Item:
    """One asked item: terms by falling weight, and the length left after each of them."""

    terms: np.ndarray
    weights: np.ndarray
    rests: np.ndarray

    @classmethod
    def of(cls, terms: np.ndarray, weights: np.ndarray) -> Item:
        order = np.lexsort((terms, -weights))
        squares = weights[order].astype(float) ** 2
        rests = np.sqrt(np.concatenate([np.cumsum(squares[::-1])[::-1], [0.0]]))
        return cls(terms[order], weights[order], rests)

    @property
    def length(self) -> float:
        return float(self.rests[0])


class Bucket:
    """Documents of similar vector length, by document and by term."""

    def __init__(self, rows: pa.RecordBatch, size: int, documents: int, total: int):
        self.ids = rows.column("doc_id")
        self.norms = rows.column("norm").to_numpy()
        lists, counts = rows.column("terms"), rows.column("counts").flatten().to_numpy()
        self.sizes = np.diff(lists.offsets.to_numpy())
        self.terms = lists.flatten().to_numpy()
        m = np.repeat(length_factor(rows.column("n").to_numpy(), documents, total), self.sizes)
        self.impacts = impact(counts, m)
        order = np.argsort(self.terms, kind="stable")
        self.owners = np.repeat(np.arange(len(self.sizes)), self.sizes)[order]
        self.by_term = self.impacts[order].astype(float)
        self.begins = np.concatenate([[0], np.cumsum(np.bincount(self.terms, minlength=size))])

    def reaching(self, item: Item, least: float) -> np.ndarray:
        """Documents whose bound reaches ``least`` after all coordinates."""
        n = len(self.norms)
        alive = np.flatnonzero(self.norms * item.length * MARGIN >= least)
        sums, squares, done = np.zeros(n), np.zeros(n), 0
        for share in CHECKPOINTS:
            if not alive.size:
                break
            upto = int(np.ceil(share * len(item.terms)))
            met, gains, lengths = [], [], []
            for term, weight in zip(item.terms[done:upto], item.weights[done:upto], strict=True):
                piece = slice(self.begins[term], self.begins[term + 1])
                met.append(self.owners[piece])
                gains.append(self.by_term[piece] * weight)
                lengths.append(self.by_term[piece])
            if met:
                met = np.concatenate(met)
                sums += np.bincount(met, np.concatenate(gains), n)
                squares += np.bincount(met, np.concatenate(lengths) ** 2, n)
            done = upto
            left = np.sqrt(np.maximum(self.norms[alive] ** 2 * MARGIN - squares[alive], 0))
            alive = alive[(sums[alive] + item.rests[upto] * left) * MARGIN >= least]
        return alive

    def scores(self, item: Item, picked: np.ndarray, scratch: np.ndarray) -> np.ndarray:
        """Exact scores; ``scratch`` is a zero per term and is left so."""
        scratch[item.terms] = item.weights
        ends = np.cumsum(self.sizes)
        sizes = self.sizes[picked]
        owners = np.repeat(np.arange(len(picked)), sizes)
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = np.repeat(ends[picked] - sizes, sizes) + within
        made = np.zeros(len(picked), np.int64)
        np.add.at(made, owners, scratch[self.terms[at]] * self.impacts[at])
        scratch[item.terms] = 0
        return made


def length_factor(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    return 100 - LENGTH_SHARE + (LENGTH_SHARE * n * documents) // total


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (IMPACT_SCALE * tf) // (TERM_SCALE * tf + LENGTH_WEIGHT * m)


def _search(items: list[Item], least: list[int], size: int, documents: int, total: int, k: int):
    """The ``k`` best of a task's documents for every item, from ``least`` up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[np.ndarray, np.ndarray]] = [
            (np.zeros(0, np.int64), np.zeros(0)) for _ in items
        ]
        bars = np.maximum(np.array(least, float), 1)
        lengths = np.array([item.length for item in items])
        scratch = np.zeros(size, np.int64)
        for batch in batches:
            for begin in range(0, batch.num_rows, BUCKET_ROWS):
                rows = batch.slice(begin, BUCKET_ROWS)
                longest = pc.max(rows.column("norm")).as_py()
                asked = np.flatnonzero(lengths * longest * MARGIN >= bars)
                if not asked.size:
                    continue
                bucket = Bucket(rows, size, documents, total)
                # a missing key ranks last; keys are far from the ends of doubles' integers only
                keys = bucket.ids
                null = keys.is_null().to_numpy(zero_copy_only=False)
                keys = pc.fill_null(keys, np.iinfo(np.int64).max).to_numpy()
                for q in asked.tolist():
                    picked = bucket.reaching(items[q], bars[q])
                    if not picked.size:
                        continue
                    scores = bucket.scores(items[q], picked, scratch)
                    held, named = best[q]
                    places = np.stack([keys[picked], null[picked]], axis=1)
                    named = np.concatenate([named.reshape(-1, 2), places]).astype(np.int64)
                    held = np.concatenate([held, scores])
                    first = np.lexsort((named[:, 0], named[:, 1], ~held))[:k]
                    first = first[held[first] > 0]
                    best[q] = held[first], named[first]
                    if len(first) == k:
                        bars[q] = max(bars[q], float(held[first[-1]]))
        sizes = [len(held) for held, _ in best]
        named = np.concatenate([n.reshape(-1, 2) for _, n in best]).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(items)), sizes), pa.int32()),
                pa.array(named[:, 0], pa.int64(), mask=named[:, 1].astype(bool)),
                pa.array(np.concatenate([held for held, _ in best]), pa.int64()),
            ],
            ["query", "doc_id", "score"],
        )

    return run


def item_blocks(items: DataFrame, key: str, text: str) -> Iterator[list[tuple[object, str]]]:
    """All items in blocks of bounded text; one partition at a time reaches the driver."""
    block, held = [], 0
    rows = items.select(column(key).alias("key"), column(text).alias("text"))
    for row in rows.toLocalIterator():
        value = whole(row["text"])
        if block and (held + len(value) > BLOCK_BYTES or len(block) >= BLOCK_ITEMS):
            yield block
            block, held = [], 0
        block.append((row["key"], value))
        held += len(value)
    if block:
        yield block


def _rank_block(docs: DataFrame, block: list[tuple[object, str]], k: int) -> DataFrame | None:
    spark = docs.sparkSession
    asked = terms_of(pa.array([text for _, text in block], pa.string()))
    vocabulary = asked.listed
    size = len(vocabulary)
    counted = cut_lineage(docs.mapInArrow(_count_terms(vocabulary), COUNTED))
    documents, total = (
        counted.where("not stats").agg(F.count(F.lit(1)), F.sum("n")).first()
    )
    if not documents or not size:
        return None
    # one row per term of the block
    holders = (
        counted.where("stats")
        .select(F.explode(F.arrays_zip("terms", "counts")).alias("t"))
        .groupBy("t.terms")
        .agg(F.sum("t.counts"))
        .collect()
    )
    df = np.zeros(size)
    for term, count in holders:
        df[term] = count
    weights = np.floor(WEIGHT_SCALE * np.log((2.0 * documents + 2) / (2 * df + 1))).astype(np.int64)
    items = []
    for begin, end in zip(asked.bounds, asked.bounds[1:], strict=False):
        terms, often = np.unique(asked.codes[begin:end], return_counts=True)
        items.append(Item.of(terms, often * weights[terms]))

    factor = F.expr(f"{100 - LENGTH_SHARE}L + ({LENGTH_SHARE}L * n * {documents}L) div {total}L")
    squares = F.expr(
        "aggregate(counts, 0D, (sum, tf) -> sum + pow(cast(("
        f"{IMPACT_SCALE}L * tf) div ({TERM_SCALE}L * tf + {LENGTH_WEIGHT}L * m) as double), 2))"
    )
    vectors = (
        counted.where("not stats and size(terms) > 0")
        .withColumn("m", factor)
        .select("doc_id", "n", "terms", "counts", F.sqrt(squares).alias("norm"))
        .where("norm > 0")
        .withColumn("deal", F.monotonically_increasing_id())
    )
    # equal lengths, as those of copies, are dealt by a number of their own
    index = cut_lineage(
        vectors.repartitionByRange(partitions(spark), F.desc("norm"), "deal")
        .sortWithinPartitions(F.desc("norm"))
        .drop("deal")
    )
    lengths = index.select("norm").orderBy(F.desc("norm")).limit(SEED_ROWS)
    cut = lengths.agg(F.min("norm")).first()[0]
    if cut is None:
        return None

    def search(rows: DataFrame, least: list[int]) -> DataFrame:
        task = _search(items, least, size, documents, total, k)
        rank = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        return (
            rows.mapInArrow(task, FOUND)
            .withColumn("rank", F.row_number().over(rank))
            .where(F.col("rank") <= k)
        )

    none = [0] * len(items)
    seeds = search(index.where(F.col("norm") >= cut).limit(SEED_ROWS), none)
    least = list(none)
    # at most one row per item of the block
    for query, score in seeds.where(F.col("rank") == k).select("query", "score").collect():
        least[query] = score
    shortest = min(
        (max(score, 1) / item.length for score, item in zip(least, items, strict=True) if item.length),
        default=0.0,
    )
    found = search(index.where(F.col("norm") * MARGIN >= shortest), least)
    keys = spark.createDataFrame(
        [(i, key) for i, (key, _) in enumerate(block)], "query int, item_id long"
    )
    # one row per item of the block
    return found.join(F.broadcast(keys), "query").select("item_id", "rank", "doc_id", "score")


def rank_documents(
    docs: DataFrame, items: DataFrame, k: int, item_key: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The ``k`` best documents with a score above 0 for every item.

    ``docs`` has ``doc_id`` and ``text``. Ties go to the smaller ``doc_id``, a null
    one last. Null and empty texts have no terms and are never found; an item
    without terms has no rows. Repeated rows of either side are rows of their own.
    Empty tables give no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(column("doc_id").cast("long").alias("doc_id"), column("text").alias("text"))
    made = [_rank_block(rows, block, k) for block in item_blocks(items, item_key, item_text)]
    made = [one for one in made if one is not None]
    if not made:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    if len(made) > 1:
        made = [cut_lineage(one) for one in made]
    result = made[0]
    for one in made[1:]:
        result = result.unionAll(one)
    return result
