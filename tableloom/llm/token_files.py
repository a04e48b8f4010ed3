"""Token ids in files of fixed-width bit fields.

Every id takes the fewest bits that hold the vocabulary. Ids are packed in
blocks of whole documents; a block row keeps its bit width, the offset of its
first id within its range of the key, its least and largest key, and the
lengths of its documents, so a reader unpacks any block with numpy alone and
reaches any document without reading the others. Ranges follow each other in the
order of the key. The rows are kept in Parquet files, which every store of a
cluster can read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterator
from copy import copy
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers

from tableloom.llm.tables import partitions, texts
from tableloom.llm.words import gather, in_pieces, words_of

#: A block ends with the document that brings it to so many ids.
BLOCK_IDS = 8_192
#: Words that a worker remembers before it forgets those not met since it last did.
REMEMBERED_WORDS = 600_000
#: Texts or words handed to the library at once, whose token objects then go.
ENCODED_AT_ONCE = 4_096

BLOCK_SCHEMA = (
    "range int, block int, bits int, first long, low long, high long, doc_ids array<long>, "
    "lengths array<long>, payload binary"
)


def bits_for(vocabulary_size: int) -> int:
    return max(1, (vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Fields of ``bits`` bits, lowest bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    fields = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(fields.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, bits: int, first: int, n: int) -> np.ndarray:
    """``n`` ids from the ``first`` on, reading only the bytes that hold them."""
    if bits in (8, 16, 32):
        width = bits // 8
        return np.frombuffer(payload, f"<u{width}", n, first * width).astype(np.uint32)
    begun, ended = first * bits, (first + n) * bits
    data = np.frombuffer(payload, np.uint8)[begun // 8 : -(-ended // 8)]
    loose = np.unpackbits(data, bitorder="little")[begun % 8 :][: n * bits]
    weights = np.left_shift(1, np.arange(bits, dtype=np.uint32), dtype=np.uint32)
    return loose.reshape(n, bits).astype(np.uint32) @ weights


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    # a task has one core; without this the library starts a thread for every core of the machine
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


#: Steps that change no character between words and join none over white space.
_SAFE_NORMALIZERS = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase", "StripAccents"}
_SAFE_CUTS = {"Whitespace", "WhitespaceSplit", "BertPreTokenizer"}
_WHITE = " \t\n\x0b\x0c\r"
#: One alternative of a pattern: atoms, each a character, an escape or a class, with a repeat.
_ATOM = regex.compile(r"(\[(?:\\.\{?\w*\}?|[^\]\\])+\]|\\\w\{\w+\}|\\.|[^\\\[\](){}|+*?.^$])([+*?]?)")


def _meets_no_white_space(pattern: str) -> bool:
    """Whether a pattern is plain alternatives none of whose atoms takes white space."""
    at = 0
    while at < len(pattern):
        if pattern[at] == "|":
            at += 1
            continue
        atom = _ATOM.match(pattern, at)
        if atom is None or any(regex.fullmatch(atom[1], c) for c in _WHITE):
            return False
        at = atom.end()
    return True


def _steps(part: dict | None, inner: str) -> list[dict]:
    if part is None:
        return []
    if part["type"] == "Sequence":
        return [step for one in part[inner] for step in _steps(one, inner)]
    return [part]


def own_cut(described: dict) -> str | None:
    """Pattern of the parts that a tokenizer cuts first, if it is one that takes no white space."""
    first = next(iter(_steps(described["pre_tokenizer"], "pretokenizers")), {"type": None})
    if first["type"] != "Split" or first["behavior"] != "Removed" or not first["invert"]:
        return None
    pattern = first["pattern"].get("Regex", " ")
    return pattern if _meets_no_white_space(pattern) else None


def splits_at_white_space(described: dict) -> bool:
    """Whether the words of a text can be encoded one by one, proven from a tokenizer's description.

    Its normalizers must be known to keep words apart, its first cut must drop all
    white space, and no added token may hold any.
    """
    for step in _steps(described["normalizer"], "normalizers"):
        blank = step["type"] == "Replace" and step["pattern"] == {"Regex": "\\s+"}
        if step["type"] not in _SAFE_NORMALIZERS and not (blank and step["content"] == " "):
            return False
    cuts = _steps(described["pre_tokenizer"], "pretokenizers")
    if not cuts:
        return False
    first = cuts[0]
    drops = own_cut(described) is not None
    for step in cuts[1:]:
        adds = step["type"] == "ByteLevel" and (step["add_prefix_space"] or step["use_regex"])
        if adds or step["type"] not in ("ByteLevel", "Digits", "Punctuation"):
            return False
    whole = not any(c in token["content"] for token in described["added_tokens"] for c in _WHITE)
    return whole and (drops or first["type"] in _SAFE_CUTS)


def plain_tokenizer(model: Tokenizer, described: dict) -> tuple[Tokenizer | None, re.Pattern]:
    """The tokenizer without the steps that leave certain words unchanged, and a pattern of these words.

    No Unicode form changes printable ASCII, and NFC no Latin-1 either; in neither there is
    white space to replace. Lower-casing remains, and leads out of neither. None stands for
    a tokenizer that cuts or fills sequences, or looks for added tokens in normalised text.
    """
    steps = [step["type"] for step in _steps(described["normalizer"], "normalizers")]
    latin = {"NFC", "Lowercase", "Replace"}.issuperset(steps)
    words = re.compile("[!-~\xa1-\xff]+" if latin else "[!-~]+")
    normalised = any(token["normalized"] for token in described["added_tokens"])
    if described["truncation"] or described["padding"] or normalised:
        return None, words
    plain = Tokenizer.from_str(model.to_str())
    plain.normalizer = normalizers.Sequence([normalizers.Lowercase()] * ("Lowercase" in steps))
    return plain, words


class Encoder:
    """Ids of texts as the library makes them of the whole text.

    Where the tokenizer is proven to cut at white space, a distinct word is encoded
    once and remembered. With any other tokenizer the texts are encoded whole.
    """

    def __init__(self, path: str, end_id: int):
        self.model = tokenizer(path)
        described = json.loads(self.model.to_str())
        self.by_words = splits_at_white_space(described)
        self.plain, self.plain_words = None, None
        if self.by_words:
            self.plain, self.plain_words = plain_tokenizer(self.model, described)
        self.bits = bits_for(self.model.get_vocab_size())
        self.kind = np.dtype("<u2" if self.bits <= 16 else "<u4")
        self.end = np.array([end_id], self.kind)
        self.known = Remembered(REMEMBERED_WORDS, self.kind)

    def _encoded(self, listed: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [one.ids for one in self.model.encode_batch_fast(listed, add_special_tokens=False)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), self.kind, sizes.sum()), sizes

    def _encoded_plain(self, listed: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words as one sequence, in which the library keeps the word of every id."""
        one = self.plain.encode(listed, is_pretokenized=True, add_special_tokens=False)
        sizes = np.bincount(np.array(one.word_ids, np.int64), minlength=len(listed))
        return np.array(one.ids, self.kind), sizes

    def made(self, listed: list[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
        """Some of the words, all their ids and how many each has, until no word is left."""
        kinds = [(self._encoded, listed)]
        if self.plain is not None:
            are = list(map(self.plain_words.fullmatch, listed))
            kinds = [
                (self._encoded_plain, [word for word, is_ in zip(listed, are, strict=True) if is_]),
                (self._encoded, [word for word, is_ in zip(listed, are, strict=True) if not is_]),
            ]
        for encoded, words in kinds:
            for begin in range(0, len(words), ENCODED_AT_ONCE):
                some = words[begin : begin + ENCODED_AT_ONCE]
                yield some, *encoded(some)

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of every text and the end id, as little-endian integers."""
        end = self.end.tobytes()
        if not self.by_words:
            whole, made = [t or "" for t in texts.to_pylist()], []
            for begin in range(0, len(whole), ENCODED_AT_ONCE):
                flat, sizes = self._encoded(whole[begin : begin + ENCODED_AT_ONCE])
                ends = np.cumsum([0, *sizes]) * self.kind.itemsize
                made += [ids + end for ids in _sliced(flat.tobytes(), ends)]
            return made
        words = words_of(texts)
        picked = self.known.numbers(words.listed, self.made)[words.codes]
        flat, sizes = self.known.ids()
        ids = gather(flat, sizes, picked).tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes[picked])])[words.bounds]
        return [one + end for one in _sliced(ids, ends * self.kind.itemsize)]


class Remembered:
    """Numbered words and their ids. Beyond ``most`` words those go that were not met since that last happened."""

    def __init__(self, most: int, kind: np.dtype):
        self.most = most
        self.kind = kind
        self.older: Remembered | None = None
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.n_ids = 0
        self.flat, self.sizes = np.empty(0, self.kind), np.empty(0, np.int64)

    def ids(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and how many each has."""
        return self.flat[: self.n_ids], self.sizes[: len(self.known)]

    def add(self, words: list[str], flat: np.ndarray, sizes: np.ndarray) -> None:
        n = len(self.known)
        self.known.update(zip(words, range(n, n + len(words)), strict=True))
        self.flat = _appended(self.flat, self.n_ids, flat)
        self.sizes = _appended(self.sizes, n, sizes)
        self.n_ids += len(flat)

    def _found(self, listed: list[str]) -> np.ndarray:
        return np.fromiter(map(self.known.get, listed, repeat(-1)), np.int64, len(listed))

    def numbers(self, listed: list[str], make: Callable) -> np.ndarray:
        """The number of each of the distinct words; ``make`` gives ids of those not known."""
        if len(self.known) > self.most:
            self.older = copy(self)
            self.older.older = None
            self._clear()
        found = self._found(listed)
        fresh = np.flatnonzero(found < 0)
        if not len(fresh):
            return found
        missing = [listed[i] for i in fresh.tolist()]
        if self.older:
            before = self.older._found(missing)
            kept = before[before >= 0]
            flat, sizes = self.older.ids()
            words = [word for word, number in zip(missing, before.tolist(), strict=True) if number >= 0]
            self.add(words, gather(flat, sizes, kept), sizes[kept])
            missing = [word for word, number in zip(missing, before.tolist(), strict=True) if number < 0]
        for words, flat, sizes in make(missing):
            self.add(words, flat, sizes)
        found[fresh] = self._found([listed[i] for i in fresh.tolist()])
        return found


def _appended(held: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``more`` behind the first ``used`` entries, in an array of twice the size if there is no room."""
    upto = used + len(more)
    if upto > len(held):
        held = np.concatenate([held[:used], np.empty(2 * upto - used, held.dtype)])
    held[used:upto] = more
    return held


def _sliced(data: bytes, ends: np.ndarray) -> Iterator[bytes]:
    ends = ends.tolist()
    return (data[a:b] for a, b in zip(ends, ends[1:], strict=False))


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int) -> Encoder:
    return Encoder(path, end_id)


def block_rows(path: str, end_id: int) -> Callable:
    """Turns the sorted texts of a range into block rows."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(path, end_id)
        place, block, first, held, size = None, 0, 0, [], 0
        made: list[dict] = []

        def close() -> None:
            nonlocal block, first, held, size
            if held:
                ids = np.frombuffer(b"".join(row[1] for row in held), model.kind)
                keys = [row[0] for row in held]
                filled = [key for key in keys if key is not None]
                made.append(
                    {
                        "range": place,
                        "block": block,
                        "bits": model.bits,
                        "first": first,
                        "low": min(filled, default=None),
                        "high": max(filled, default=None),
                        "doc_ids": keys,
                        "lengths": [len(row[1]) // model.kind.itemsize for row in held],
                        "payload": pack(ids, model.bits),
                    }
                )
                block, first, held, size = block + 1, first + len(ids), [], 0

        for batch in in_pieces(batches, "text"):
            rows = zip(
                batch.column("range").to_pylist(),
                batch.column("doc_id").to_pylist(),
                model.encode(batch.column("text")),
                strict=True,
            )
            for range_, doc_id, ids in rows:
                if range_ != place:
                    close()
                    place, block, first = range_, 0, 0
                held.append((doc_id, ids))
                size += len(ids) // model.kind.itemsize
                if size >= BLOCK_IDS:
                    close()
            if made:
                yield pa.RecordBatch.from_pylist(made, BLOCK_TYPES)
                made = []
        close()
        if made:
            yield pa.RecordBatch.from_pylist(made, BLOCK_TYPES)

    return blocks


BLOCK_TYPES = pa.schema(
    [
        ("range", pa.int32()),
        ("block", pa.int32()),
        ("bits", pa.int32()),
        ("first", pa.int64()),
        ("low", pa.int64()),
        ("high", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("payload", pa.binary()),
    ]
)


def write_tokens(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str) -> None:
    """Encode every text, append ``end_id`` and write the files in the order of ``doc_id``.

    A null or empty text is written as the end id alone. Rows of equal ``doc_id``
    follow by a hash of their text; null keys come first. A key that many rows have
    is split between ranges. Texts are shuffled once and encoded where they arrive.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("deal")]
    rows = texts(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.monotonically_increasing_id().alias("deal"),
    )
    ordered = (
        rows.repartitionByRange(partitions(docs.sparkSession), *order)
        .withColumn("range", F.spark_partition_id())
        .sortWithinPartitions(*order)
        .select("range", "doc_id", "text")
    )
    ordered.mapInArrow(block_rows(tokenizer_path, end_id), BLOCK_SCHEMA).write.parquet(folder)


def range_starts(blocks: DataFrame) -> dict[int, int]:
    """Ids before each range; one entry per range, so bounded by the partitions."""
    zero = F.lit(0).cast("long")
    totals = (
        blocks.select("range", F.aggregate("lengths", zero, lambda a, x: a + x).alias("n"))
        .groupBy("range")
        .agg(F.sum("n").alias("n"))
        .orderBy("range")
        .collect()
    )
    starts, before = {}, 0
    for row in totals:
        starts[row["range"]] = before
        before += row["n"]
    return starts


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before), ``n_tokens`` and ``ids``."""
    return _read(
        spark.read.parquet(folder),
        "ids array<long>",
        lambda ids: {"ids": pa.array(ids, pa.list_(pa.int64()))},
    )


def read_checksums(spark: SparkSession, folder: str) -> DataFrame:
    """As ``read_tokens``, with the CRC-32 of the ids as 32-bit integers instead of them."""
    return _read(
        spark.read.parquet(folder),
        "ids_crc32 long",
        lambda ids: {"ids_crc32": [zlib.crc32(one.astype("<u4").tobytes()) for one in ids]},
    )


def document_ids(blocks: DataFrame, doc_id: int) -> np.ndarray:
    """Random access: the ids of one document, unpacked from its block only.

    The least and largest keys of the blocks leave all other blocks unread.
    """
    near = blocks.where((F.col("low") <= doc_id) & (F.col("high") >= doc_id))
    row = near.where(F.array_contains("doc_ids", F.lit(doc_id))).limit(1).collect()
    if not row:
        raise KeyError(doc_id)
    place = row[0]["doc_ids"].index(doc_id)
    lengths = row[0]["lengths"]
    return unpack(bytes(row[0]["payload"]), row[0]["bits"], sum(lengths[:place]), lengths[place])


def _read(blocks: DataFrame, kind: str, made: Callable) -> DataFrame:
    starts = range_starts(blocks)

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], dtype=np.int64)
                ends = np.cumsum(lengths)
                ids = unpack(row["payload"], row["bits"], 0, int(ends[-1]))
                before = starts[row["range"]] + row["first"]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(row["doc_ids"], pa.int64()),
                        "start": before + ends - lengths,
                        "n_tokens": lengths,
                    }
                    | made(np.split(ids, ends[:-1]))
                )

    return blocks.mapInArrow(unpacked, f"doc_id long, start long, n_tokens long, {kind}")
