"""Quality rules from the tokens that a public vocabulary makes of a text.

A text is refused if it fails the base rules (too few words, too much repeated
text) or if one of its tokeniser measures lies outside the band of its script:
characters per token, share of byte-fallback tokens, entropy of the tokens.

Every distinct word of a batch is encoded once and by itself, so white space is
not measured.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableloom.llm.tables import keep_rows, texts
from tableloom.llm.words import Words, gather, in_pieces, words_of

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, script string, "
    "n_tokens long, chars_per_token double, byte_share double, token_entropy double"
)


@dataclass(frozen=True)
class Band:
    """Accepted range of each measure; a value on the edge is accepted."""

    chars_per_token: tuple[float, float]
    byte_share: float
    token_entropy: float


#: Fixed values. The vocabulary covers Latin best, other alphabets by letters or
#: byte fallback; unwritten scripts get the widest band.
BANDS = {
    "latin": Band((1.3, 8.0), 0.02, 4.0),
    "greek": Band((0.8, 6.0), 0.30, 3.0),
    "cyrillic": Band((1.2, 7.0), 0.10, 3.5),
    "han": Band((0.4, 3.0), 0.70, 3.0),
    "kana": Band((0.4, 3.0), 0.70, 3.0),
    "hangul": Band((0.3, 3.0), 0.80, 3.0),
    "other": Band((0.25, 8.0), 0.95, 2.0),
}

#: Scripts by their letters, the first of equally frequent ones wins.
SCRIPTS = {
    "latin": re.compile("[A-Za-zÀ-ɏ]"),
    "greek": re.compile("[Ͱ-Ͽ]"),
    "cyrillic": re.compile("[Ѐ-ԯ]"),
    "han": re.compile("[㐀-䶿一-鿿]"),
    "kana": re.compile("[぀-ヿ]"),
    "hangul": re.compile("[가-힯]"),
}
OUTSIDE_LATIN = re.compile("[Ͱ-\U0010ffff]")


def script_of(text: str) -> str:
    if not OUTSIDE_LATIN.search(text):
        return "latin" if SCRIPTS["latin"].search(text) else "other"
    found = {name: len(letters.findall(text)) for name, letters in SCRIPTS.items()}
    best = max(found, key=found.get)
    return best if found[best] else "other"


@lru_cache(maxsize=4)
def vocabulary(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=4)
def byte_ids(path: str) -> np.ndarray:
    model = vocabulary(path)
    return np.array([model.is_byte(i) for i in range(model.vocab_size())], dtype=bool)


def repeated_words(words: Words) -> np.ndarray:
    """Of each text, the words inside windows of eight that it has twice or more."""
    n = max(len(words.codes) - WINDOW + 1, 0)
    owners = words.owners
    first = owners[:n]
    spread = (words.codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    spread ^= spread >> np.uint64(29)
    sums = first.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    factor = 1
    for k in range(WINDOW):
        sums += spread[k : k + n] * np.uint64(factor)
        factor = factor * 0xD6E8FEB86659FD93 % 2**64
    places = np.flatnonzero(first == owners[len(owners) - n :])
    if not places.size:
        return np.zeros(len(words.bounds) - 1, np.int64)
    order = np.argsort(sums[places])
    same = np.concatenate([[False], np.diff(sums[places][order]) == 0, [False]])
    suspects = places[order[same[1:] | same[:-1]]]
    # equal sums are only likely to be equal windows, so these are compared themselves
    columns = [first[suspects], *(words.codes[suspects + k] for k in range(WINDOW))]
    rows = np.ascontiguousarray(np.stack(columns, axis=1)).astype(np.int64)
    keys = rows.view(np.dtype((np.void, rows.itemsize * (WINDOW + 1)))).ravel()
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    covered = np.zeros(len(words.codes), dtype=bool)
    for k in range(WINDOW):
        covered[suspects[counts[inverse] > 1] + k] = True
    return np.bincount(owners[covered], minlength=len(words.bounds) - 1)


def token_measures(words: Words, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: tokens, byte-fallback tokens, entropy in bits."""
    model = vocabulary(path)
    rows = model.encode(words.listed, num_threads=1)
    lengths = np.fromiter(map(len, rows), np.int64, len(rows))
    flat = np.fromiter(chain.from_iterable(rows), np.int64, int(lengths.sum()))
    size = len(words.bounds) - 1
    owners = np.repeat(words.owners, lengths[words.codes])
    ids = gather(flat, lengths, words.codes)
    n_tokens = np.bincount(owners, minlength=size)
    n_bytes = np.bincount(owners[byte_ids(path)[ids]], minlength=size)
    kinds, counts = np.unique(owners * model.vocab_size() + ids, return_counts=True)
    kind_owners = kinds // model.vocab_size()
    shares = counts / n_tokens[kind_owners]
    entropy = np.bincount(kind_owners, weights=-shares * np.log2(shares), minlength=size)
    return n_tokens, n_bytes, entropy


def text_counts(text: str) -> tuple[int, int, int, str]:
    """Characters in words, symbols, repeated lines, script."""
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    return (
        len(text) - sum(map(text.count, WHITE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        script_of(text),
    )


def in_band(band: Band, per_token: float, byte_share: float, entropy: float) -> bool:
    low, high = band.chars_per_token
    return (
        low <= per_token <= high
        and byte_share <= band.byte_share
        and entropy >= band.token_entropy
    )


def judge(texts: pa.Array, path: str, bands: dict[str, Band]) -> dict[str, list]:
    words = words_of(texts)
    n_words, repeated = words.counts, repeated_words(words)
    n_tokens, n_bytes, entropy = token_measures(words, path)
    plain = [text_counts(text or "") for text in texts.to_pylist()]
    chars = np.array([row[0] for row in plain], dtype=np.int64)
    failed = (n_words < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * n_words)
    some = np.maximum(n_tokens, 1)
    per_token, share = chars / some, n_bytes / some
    inside = [
        in_band(bands[row[3]], *values)
        for row, *values in zip(plain, per_token, share, entropy, strict=True)
    ]
    none = n_tokens == 0
    return {
        "n_words": n_words,
        "word_chars": chars,
        "n_symbols": [row[1] for row in plain],
        "n_dup_lines": [row[2] for row in plain],
        "n_repeat_words": repeated,
        "base_failed": failed,
        "kept": ~failed & np.array(inside, dtype=bool),
        "script": [row[3] for row in plain],
        "n_tokens": n_tokens,
        "chars_per_token": pa.array(per_token, mask=none),
        "byte_share": pa.array(share, mask=none),
        "token_entropy": pa.array(entropy, mask=none),
    }


def fertility(docs: DataFrame, model_path: str, bands: dict[str, Band] | None = None) -> DataFrame:
    """Counts, tokeniser measures and the verdict of every text.

    Reads ``doc_id`` and ``text``; other columns are left aside. A null or
    empty text has no words, hence fails the base rules, and its measures are
    null. Repeated rows each get their own, equal row. No shuffle takes place.
    """
    limits = bands or BANDS

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, "text"):
            made = judge(batch.column("text"), model_path, limits)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **made})

    rows = texts(docs, "doc_id", "text")
    return rows.withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(judged, SCHEMA)


def keep_by_rules(
    docs: DataFrame, model_path: str, bands: dict[str, Band] | None = None
) -> DataFrame:
    """Whole rows that the rules keep."""
    limits = bands or BANDS
    return keep_rows(docs, lambda batch: judge(batch, model_path, limits)["kept"])
