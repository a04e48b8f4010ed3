"""Prefix trie of conversations from padded matrices of turn ids.

A turn is two 64-bit hashes of its role and text, so texts move no further than
the first read. Conversations are cut into bands of ``BAND`` turns. A row of a
band holds the ids of its turns and of the next one, and a hash of all turns
before it, so bands need not wait for each other, however long a conversation is.

Rows are dealt to range shards by (band, hash before, ids, conversation). In a
shard the ids are a padded matrix, put in order by ``lexsort``. A row starts a
node at a depth if it differs from the row before it there or further left: the
column changes, accumulated by OR. ``reduceat`` over the starts sums every depth.
Nodes that reach the first or the last row of a shard may go on in others; their
parts are recombined by Spark, and a second pass over the shards sums subtrees.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableloom.functions.columns import column
from tableloom.llm.tables import partitions, word_count
from tableloom.session import cut_lineage

#: Turns of a band.
BAND = 16
#: Rows of a shard, about.
SHARD_ROWS = 32_768
#: Bands whose hashes one task runs through.
BLOCK_BANDS = 256
#: Conversations take the first turns of the one whose id is the next lower multiple of this.
FAMILY = 20
#: One more than the most turns so taken.
HEADS = 4

NO_ENDS = hashlib.sha256(b"").hexdigest()

PARTS = (
    "kind string, shard int, key string, parent string, band long, col int, conv long, "
    "n_convs long, tokens long, children long, n_ends long, ends string, leaves long, saved long"
)
NODES = (
    "key string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string"
)


def turn_rows(conversations: DataFrame) -> DataFrame:
    """``conv_id``, position from 0, two hashes and the words of every turn.

    Rows are numbered in ranges of (conversation, turn), so a long conversation
    is split between tasks; what its earlier ranges hold is added by the range.
    """
    role = F.coalesce(column("role").cast("string"), F.lit(""))
    text = F.coalesce(column("text").cast("string"), F.lit(""))
    turns = conversations.where(column("conv_id").isNotNull()).select(
        column("conv_id").cast("long").alias("conv_id"),
        column("turn").alias("turn"),
        F.xxhash64(role, text).alias("a"),
        F.xxhash64(F.lit(1), text, role).alias("b"),
        word_count(text).alias("tokens"),
        F.monotonically_increasing_id().alias("deal"),
    )
    order = ["conv_id", F.asc_nulls_first("turn"), "a", "b", "deal"]
    ranges = cut_lineage(
        turns.repartitionByRange(partitions(turns.sparkSession), *order).withColumn(
            "shard", F.spark_partition_id()
        )
    )
    # A conversation in several ranges is the first of one of them: at most one row a range,
    # so these tables have at most two rows for every shuffle partition of the session.
    firsts = ranges.groupBy("shard").agg(F.min("conv_id").alias("conv_id"))
    spread = F.broadcast(firsts.select("conv_id").distinct())
    counts = ranges.join(spread, "conv_id", "left_semi").groupBy("conv_id", "shard").count()
    earlier = Window.partitionBy("conv_id").orderBy("shard").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = counts.select(
        "conv_id", "shard", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before")
    ).where("before > 0")
    inside = Window.partitionBy("shard", "conv_id").orderBy(*order[1:])
    return ranges.withColumn("n", F.row_number().over(inside)).join(
        F.broadcast(before), ["conv_id", "shard"], "left"
    ).select(
        "conv_id",
        (F.col("n") - 1 + F.coalesce("before", F.lit(0))).cast("long").alias("pos"),
        "a",
        "b",
        "tokens",
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations with depths from 1, and all conversations.

    A conversation starts with the first ``h`` turns of the head of its family and
    goes on with its own after the first ``h``.
    """
    conv = F.col("conv_id")
    base = conv - conv % FAMILY
    # a head keeps its own turns
    taken = F.when(base == conv, 0).otherwise(F.crc32(conv.cast("string")) % HEADS)
    lengths = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    convs = lengths.select("conv_id", base.alias("base"), taken.alias("taken"))
    # the shorter a head, the higher the own turns move up
    of_base = lengths.select(conv.alias("base"), F.col("n").alias("base_n"))
    short = (
        convs.where("taken > 0")
        .join(of_base, "base", "left")
        .select("conv_id", (F.col("taken") - F.coalesce("base_n", F.lit(0))).alias("missing"))
        .where("missing > 0")
    )
    own = (
        turns.where(F.col("pos") >= taken)
        .join(short, "conv_id", "left")
        .select(
            "conv_id",
            (F.col("pos") + 1 - F.coalesce("missing", F.lit(0))).alias("depth"),
            "a",
            "b",
            "tokens",
        )
    )
    first = turns.where((F.col("pos") < HEADS - 1) & (base == conv))
    heads = (
        first.withColumnRenamed("conv_id", "base")
        .join(convs.where("taken > 0"), "base")
        .where(F.col("pos") < F.col("taken"))
        .select("conv_id", (F.col("pos") + 1).alias("depth"), "a", "b", "tokens")
    )
    return own.unionByName(heads), convs.select("conv_id")


def band_rows(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per conversation and band: hashes of all turns before, ids and words of its turns.

    A band has ``BAND`` turns and the first of the next one. A conversation that
    ends with a band has an empty row in the next.
    """
    depth = F.col("depth")
    inner = (depth - 1) % BAND + 1
    band = F.floor((depth - 1) / BAND)
    cell = lambda where, col, own: F.struct(
        where.cast("long").alias("band"), F.lit(col).cast("int").alias("col"), F.lit(own).alias("own")
    )
    places = F.array(
        F.struct(band.cast("long").alias("band"), inner.cast("int").alias("col"), F.lit(True).alias("own")),
        F.when((inner == 1) & (band > 0), cell(band - 1, BAND + 1, False)),
        F.when(inner == BAND, cell(band + 1, 0, False)),
    )
    cells = turns.select(
        "conv_id",
        "a",
        "b",
        "tokens",
        F.xxhash64("a", "depth").alias("x"),
        F.xxhash64("depth", "b").alias("y"),
        F.explode(F.array_compact(places)).alias("at"),
    ).select("conv_id", "at.*", "a", "b", "tokens", "x", "y")
    zero = F.lit(0).cast("long")
    begun = convs.select(
        "conv_id",
        zero.alias("band"),
        F.lit(0).alias("col"),
        F.lit(False).alias("own"),
        *[zero.alias(name) for name in ("a", "b", "tokens", "x", "y")],
    )
    block = F.floor(F.col("band") / BLOCK_BANDS).alias("block")
    per_band = (
        cells.unionByName(begun)
        .withColumn("block", block)
        .repartition("conv_id", "block")
        .groupBy("conv_id", "block", "band")
        .agg(
            F.sort_array(
                F.collect_list(F.when(F.col("col") > 0, F.struct("col", "a", "b", "tokens")))
            ).alias("cells"),
            F.bit_xor(F.when(F.col("own"), F.col("x")).otherwise(0)).alias("x"),
            F.bit_xor(F.when(F.col("own"), F.col("y")).otherwise(0)).alias("y"),
        )
    )
    earlier = Window.partitionBy("conv_id", "block").orderBy("band").rowsBetween(
        Window.unboundedPreceding, -1
    )
    xor = lambda name, rows: F.coalesce(F.bit_xor(name).over(rows), zero)
    rows = cut_lineage(
        per_band.select(
            "conv_id",
            "block",
            "band",
            xor("x", earlier).alias("x_before"),
            xor("y", earlier).alias("y_before"),
            "x",
            "y",
            F.flatten(F.transform("cells", lambda c: F.array(c["a"], c["b"]))).alias("path"),
            F.transform("cells", lambda c: c["tokens"]).alias("tokens"),
        )
    )
    earlier_blocks = Window.partitionBy("conv_id").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # only conversations of several blocks, a row for 4,096 turns
    long_convs = rows.where("block > 0").select("conv_id").distinct()
    carried = (
        rows.join(long_convs, "conv_id", "left_semi")
        .groupBy("conv_id", "block")
        .agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
        .select(
            "conv_id",
            "block",
            xor("x", earlier_blocks).alias("x_carried"),
            xor("y", earlier_blocks).alias("y_carried"),
        )
        .where("block > 0")
    )
    before = lambda name: F.col(f"{name}_before").bitwiseXOR(
        F.coalesce(F.col(f"{name}_carried"), zero)
    )
    return rows.join(carried, ["conv_id", "block"], "left").select(
        "conv_id", "band", before("x").alias("x"), before("y").alias("y"), "path", "tokens"
    )


def padded(lists: pa.ListArray, width: int) -> np.ndarray:
    """Lists of integers as rows, filled up with zeros."""
    made = np.zeros((len(lists), width), np.int64)
    made[np.arange(width) < np.diff(lists.offsets.to_numpy())[:, None]] = lists.flatten().to_numpy()
    return made


@dataclass
class Depth:
    """Nodes of one column of a shard: first rows, ends, members, and which touch the borders."""

    begins: np.ndarray
    ends: np.ndarray
    alive: np.ndarray
    convs: np.ndarray
    n_convs: np.ndarray
    n_ends: np.ndarray
    tokens: np.ndarray
    border: np.ndarray


class Shard:
    """Rows of a shard in order, and their nodes by column; column 0 is what stands before a band."""

    def __init__(self, table: pa.Table):
        rows = table.combine_chunks().to_batches()[0]
        conv, band, x, y = (rows.column(c).to_numpy() for c in ("conv_id", "band", "x", "y"))
        ids = padded(rows.column("path"), 2 * (BAND + 1))
        tokens = padded(rows.column("tokens"), BAND + 1)
        sizes = np.diff(rows.column("tokens").offsets.to_numpy())
        filled = np.arange(BAND + 1) < sizes[:, None]
        keys = [band, x, y]
        for j in range(BAND + 1):
            keys += [filled[:, j], ids[:, 2 * j], ids[:, 2 * j + 1]]
        order = np.lexsort((conv, *keys[::-1]))
        self.conv, self.band, self.x, self.y = conv[order], band[order], x[order], y[order]
        self.ids, self.sizes = ids[order], sizes[order]
        filled, tokens = filled[order], tokens[order]
        n = len(order)

        def changes(values: np.ndarray) -> np.ndarray:
            return np.concatenate([[True], values[1:] != values[:-1]])

        change = np.empty((n, BAND + 2), bool)
        change[:, 0] = changes(self.band) | changes(self.x) | changes(self.y)
        for j in range(BAND + 1):
            change[:, j + 1] = (
                changes(filled[:, j]) | changes(self.ids[:, 2 * j]) | changes(self.ids[:, 2 * j + 1])
            )
        self.starts = np.logical_or.accumulate(change, axis=1)
        self.filled = np.concatenate([np.ones((n, 1), bool), filled], axis=1)
        self.depths = []
        for j in range(BAND + 2):
            begins = np.flatnonzero(self.starts[:, j])
            ends = np.append(begins[1:], n)
            self.depths.append(
                Depth(
                    begins,
                    ends,
                    self.filled[begins, j],
                    np.minimum.reduceat(self.conv, begins),
                    ends - begins,
                    np.add.reduceat((self.sizes == j).astype(np.int64), begins),
                    tokens[begins, j - 1] if j else np.zeros(len(begins), np.int64),
                    (begins == 0) | (ends == n),
                )
            )

    def node_of_rows(self, j: int) -> np.ndarray:
        return np.cumsum(self.starts[:, j]) - 1

    def children(self, j: int, inner: bool = False) -> np.ndarray:
        """Children of the nodes of column ``j``; with ``inner`` those off the borders only."""
        below = self.depths[j + 1]
        counted = below.alive & ~below.border if inner else below.alive
        marks = np.zeros(len(self.conv), np.int64)
        marks[below.begins[counted]] = 1
        return np.add.reduceat(marks, self.depths[j].begins)

    def ended(self, j: int, i: int) -> str:
        """Ids of the conversations that end with node ``i`` of column ``j``; these rows come first."""
        depth = self.depths[j]
        begin = depth.begins[i]
        return ",".join(map(str, self.conv[begin : begin + depth.n_ends[i]].tolist()))

    def key(self, row: int, j: int) -> str:
        head = (self.band[row], self.x[row], self.y[row], j)
        path = np.ascontiguousarray(self.ids[row, : 2 * j])
        data = np.array(head, np.int64).tobytes() + path.tobytes()
        return hashlib.blake2b(data, digest_size=20).hexdigest()

    def borders(self) -> Iterator[tuple[int, int, str]]:
        """Column, number and key of the nodes that touch the first or last row."""
        for j, depth in enumerate(self.depths):
            for i in np.flatnonzero(depth.border & depth.alive).tolist():
                yield j, i, self.key(int(depth.begins[i]), j)

    def own(self) -> tuple[np.ndarray, np.ndarray]:
        """Leaves and savings of the nodes off the borders, at their first rows."""
        leaves = np.zeros((len(self.conv), BAND + 1), np.int64)
        saved = np.zeros_like(leaves)
        for j in range(1, BAND + 1):
            depth = self.depths[j]
            kept = depth.alive & ~depth.border
            at = depth.begins[kept]
            leaves[at, j] = self.children(j)[kept] == 0
            saved[at, j] = (depth.n_convs[kept] - 1) * depth.tokens[kept]
        return leaves, saved


def sharded(bands: DataFrame) -> DataFrame:
    n = bands.count()
    return bands.repartitionByRange(
        max(1, -(-n // SHARD_ROWS)), "band", "x", "y", "path", "conv_id"
    ).withColumn("shard", F.spark_partition_id())


_PARTS = pa.schema(
    [
        ("kind", pa.string()),
        ("shard", pa.int32()),
        ("key", pa.string()),
        ("parent", pa.string()),
        ("band", pa.int64()),
        ("col", pa.int32()),
        *[(name, pa.int64()) for name in ("conv", "n_convs", "tokens", "children", "n_ends")],
        ("ends", pa.string()),
        ("leaves", pa.int64()),
        ("saved", pa.int64()),
    ]
)


def border_parts(table: pa.Table) -> pa.Table:
    """First pass over a shard: its part of the nodes at its borders, and totals of band rows.

    A total of kind ``band`` is asked for by a row whose conversation goes on in
    the next band, or read by such a row of an earlier band.
    """
    shard, number = Shard(table), table.column("shard")[0].as_py()
    made = []
    inner: dict[int, np.ndarray] = {}
    for j, i, key in shard.borders():
        depth = shard.depths[j]
        row = int(depth.begins[i])
        if j <= BAND and j not in inner:
            inner[j] = shard.children(j, inner=True)
        made.append(
            {
                "kind": "node",
                "shard": number,
                "key": key,
                "parent": shard.key(row, j - 1) if j else None,
                "band": int(shard.band[row]),
                "col": j,
                "conv": int(depth.convs[i]),
                "n_convs": int(depth.n_convs[i]),
                "tokens": int(depth.tokens[i]),
                "children": int(inner[j][i]) if j <= BAND else 0,
                "n_ends": int(depth.n_ends[i]),
                "ends": shard.ended(j, i) if j <= BAND and depth.n_ends[i] else None,
            }
        )
    leaves, saved = shard.own()
    linked = np.flatnonzero((shard.band > 0) | (shard.sizes >= BAND))
    totals = pa.table(
        {
            "kind": pa.array(["band"] * len(linked), pa.string()),
            "shard": pa.array([number] * len(linked), pa.int32()),
            "band": shard.band[linked],
            "conv": shard.conv[linked],
            "leaves": leaves[linked].sum(axis=1),
            "saved": saved[linked].sum(axis=1),
        }
    )
    nodes = pa.Table.from_pylist(made, _PARTS)
    return pa.concat_tables([nodes, totals], promote_options="default").select(_PARTS.names)


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the ids of each key, which come in order; only one key is held."""
    key, digest = None, None
    for batch in batches:
        keys, made = [], []
        for next_key, ends in zip(
            batch.column("key").to_pylist(), batch.column("ends").to_pylist(), strict=True
        ):
            if next_key != key:
                if key is not None:
                    keys.append(key)
                    made.append(digest.hexdigest())
                key, digest = next_key, hashlib.sha256(ends.encode())
            else:
                digest.update(b"," + ends.encode())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array(made, pa.string())], ["key", "sha"]
        )
    if key is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([key]), pa.array([digest.hexdigest()])], ["key", "sha"]
        )


def recombined(parts: DataFrame) -> DataFrame:
    """Whole border nodes from their parts in several shards."""
    pieces = parts.where("kind = 'node'")
    nodes = pieces.groupBy("key").agg(
        F.first("parent").alias("parent"),
        F.first("band").alias("band"),
        F.first("col").alias("col"),
        F.min("shard").alias("owner"),
        F.min("conv").alias("conv"),
        F.sum("n_convs").alias("n_convs"),
        F.first("tokens").alias("tokens"),
        F.sum("children").alias("children"),
    )
    # a border node's parent is one as well; it has counted only its other children
    below = nodes.groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("border_children"))
    above = nodes.select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv"))
    # digests run over ids in order: a node's pieces pass one task, one at a time
    digests = (
        pieces.where("ends is not null")
        .select("key", "shard", "ends")
        .repartition("key")
        .sortWithinPartitions("key", "shard")
        .select("key", "ends")
        .mapInArrow(_hash_ends, "key string, sha string")
    )
    children = F.col("children") + F.coalesce("border_children", F.lit(0))
    whole = (
        nodes.join(below, "key", "left")
        .join(above, "parent", "left")
        .join(digests, "key", "left")
        .withColumn("n_children", children)
    )
    named = F.col("col").between(1, BAND)
    return whole.select(
        "key",
        "band",
        "col",
        "owner",
        "conv",
        "parent_conv",
        "n_convs",
        "n_children",
        F.when(named & (F.col("n_children") == 0), 1).otherwise(0).cast("long").alias("leaves"),
        F.when(named, (F.col("n_convs") - 1) * F.col("tokens")).otherwise(0).alias("saved"),
        F.coalesce("sha", F.lit(NO_ENDS)).alias("sha"),
    )


def later_bands(parts: DataFrame, nodes: DataFrame) -> DataFrame:
    """For rows whose conversation goes on: leaves and savings of the nodes it starts in later bands."""
    rows = parts.where("kind = 'band'").select("conv", "band", "leaves", "saved")
    border = nodes.where("band > 0").select("conv", "band", "leaves", "saved")
    totals = (
        rows.unionByName(border)
        .groupBy("conv", "band")
        .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    )
    # a row for 16 turns, of conversations longer than that
    later = Window.partitionBy("conv").orderBy(F.desc("band")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    sums = totals.select(
        "conv", "band", F.sum("leaves").over(later).alias("leaves"), F.sum("saved").over(later).alias("saved")
    ).where("leaves > 0 or saved > 0")
    wants = parts.where("kind = 'band'").select("conv", "band", "shard")
    return wants.join(sums, ["conv", "band"])


def sum_subtrees(table: pa.Table) -> pa.Table:
    """Second pass over a shard, with what is known of its border nodes and of later bands."""
    kinds = table.column("kind")
    shard = Shard(table.filter(pc.equal(kinds, "row")))
    number = table.column("shard")[0].as_py()
    known = {r["key"]: r for r in table.filter(pc.equal(kinds, "node")).to_pylist()}
    leaves, saved = shard.own()
    tail_leaves, tail_saved = (np.zeros(len(shard.conv), np.int64) for _ in range(2))
    later = {
        (r["conv_id"], r["band"]): r for r in table.filter(pc.equal(kinds, "tail")).to_pylist()
    }
    if later:
        for row in np.flatnonzero(shard.sizes >= BAND).tolist():
            found = later.get((int(shard.conv[row]), int(shard.band[row])))
            if found:
                tail_leaves[row], tail_saved[row] = found["leaves"], found["saved"]
    keys = {}
    first = [depth.convs.copy() for depth in shard.depths]
    for j, i, key in shard.borders():
        keys[j, i] = key
        first[j][i] = known[key]["conv_id"]
        if known[key]["owner"] == number and j <= BAND:
            row = shard.depths[j].begins[i]
            leaves[row, j], saved[row, j] = known[key]["leaves"], known[key]["saved"]
    leaves = np.cumsum(leaves[:, ::-1], axis=1)[:, ::-1] + tail_leaves[:, None]
    saved = np.cumsum(saved[:, ::-1], axis=1)[:, ::-1] + tail_saved[:, None]

    made = []
    for j in range(BAND + 1):
        depth = shard.depths[j]
        kept = np.flatnonzero(depth.alive & ((j > 0) | (shard.band[depth.begins] == 0)))
        if not kept.size:
            continue
        border = depth.border[kept]
        parent = (
            first[j - 1][shard.node_of_rows(j - 1)[depth.begins[kept]]]
            if j
            else np.zeros(len(kept), np.int64)
        )
        ends = [
            hashlib.sha256(shard.ended(j, i).encode()).hexdigest() if n else NO_ENDS
            for i, n in zip(kept.tolist(), depth.n_ends[kept].tolist(), strict=True)
        ]
        made.append(
            pa.table(
                {
                    "key": pa.array([keys.get((j, i)) for i in kept.tolist()], pa.string()),
                    "conv_id": depth.convs[kept],
                    "depth": shard.band[depth.begins[kept]] * BAND + j,
                    "parent_conv_id": pa.array(parent, mask=np.full(len(kept), j == 0)),
                    "n_convs": depth.n_convs[kept],
                    "n_children": shard.children(j)[kept],
                    "n_leaves": np.add.reduceat(leaves[:, j], depth.begins)[kept],
                    "saved_tokens": np.add.reduceat(saved[:, j], depth.begins)[kept],
                    "ends_sha256": pa.array(
                        [None if b else e for b, e in zip(border.tolist(), ends, strict=True)],
                        pa.string(),
                    ),
                }
            )
        )
    return pa.concat_tables(made) if made else _no_nodes()


def _no_nodes() -> pa.Table:
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    kinds = [("key", pa.string()), *[(n, pa.int64()) for n in names], ("ends_sha256", pa.string())]
    return pa.table({n: pa.array([], k) for n, k in kinds})


def _context(df: DataFrame, kind: str, **columns: Column) -> DataFrame:
    """Rows of one shape for the second pass, nulls where ``columns`` says nothing."""
    shape = (
        "conv_id long, band long, x long, y long, path array<long>, tokens array<long>, "
        "key string, owner int, leaves long, saved long"
    )
    named = [part.strip().split(" ", 1) for part in shape.split(",")]
    return df.select(
        F.lit(kind).alias("kind"),
        F.col("shard"),
        *[columns.get(n, F.lit(None)).cast(k).alias(n) for n, k in named],
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct beginning of the rebuilt conversations, the empty one included.

    ``conversations`` has ``conv_id``, ``turn``, ``role`` and ``text``. Rows without
    ``conv_id`` belong to no conversation. Null turns come first; rows of one turn
    number are ordered by a hash of role and text. Null role or text is empty.
    Repeated rows are turns of their own. An empty table has no nodes.
    """
    turns = cut_lineage(turn_rows(conversations))
    rows = cut_lineage(sharded(band_rows(*rebuilt(turns))))
    parts = cut_lineage(rows.groupBy("shard").applyInArrow(border_parts, PARTS))
    nodes = cut_lineage(recombined(parts))
    known = parts.where("kind = 'node'").select("shard", "key").join(nodes, "key")
    tails = later_bands(parts, nodes)
    given = lambda *names: {n: F.col(n) for n in names}
    together = (
        _context(rows, "row", **given("conv_id", "band", "x", "y", "path", "tokens"))
        .unionByName(
            _context(known, "node", conv_id=F.col("conv"), **given("key", "owner", "leaves", "saved"))
        )
        .unionByName(
            _context(tails, "tail", conv_id=F.col("conv"), **given("band", "leaves", "saved"))
        )
    )
    summed = cut_lineage(together.groupBy("shard").applyInArrow(sum_subtrees, NODES))
    border = (
        summed.where("key is not null")
        .groupBy("key")
        .agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
        .join(nodes, "key")
        .select(
            F.col("conv").alias("conv_id"),
            (F.col("band") * BAND + F.col("col")).alias("depth"),
            F.col("parent_conv").alias("parent_conv_id"),
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.col("sha").alias("ends_sha256"),
        )
    )
    return summed.where("key is null").drop("key").unionByName(border)
