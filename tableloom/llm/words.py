"""Words of a batch of texts as integer codes, split and counted by Arrow."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20


def in_pieces(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in smaller ones, by the bytes of the named text columns."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.zeros(batch.num_rows, np.int64)
        for name in names:
            sizes += pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy()
        begins = np.flatnonzero(np.diff(np.cumsum(sizes) // PIECE_BYTES, prepend=-1)).tolist()
        for begin, end in zip(begins, [*begins[1:], batch.num_rows], strict=True):
            yield batch.slice(begin, end - begin)


@dataclass(frozen=True)
class Words:
    """``codes`` of all words in order; text ``i`` owns ``bounds[i]:bounds[i + 1]``."""

    codes: np.ndarray
    bounds: np.ndarray
    listed: list[str]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def words_of(texts: pa.Array) -> Words:
    """Split at ASCII white space (9 to 13 and 32); null texts have no words."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = parts.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    listed = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy())]).astype(int)
    if "" in listed:
        kept = codes != listed.index("")
        ends = np.concatenate([[0], np.cumsum(kept)])[ends]
        codes = codes[kept]
    return Words(codes, ends, listed)


def gather(flat: np.ndarray, lengths: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """Concatenation of the pieces ``picked`` of ``flat``, piece ``i`` being ``lengths[i]`` long."""
    starts = np.cumsum(lengths) - lengths
    sizes = lengths[picked]
    ends = np.cumsum(sizes)
    return flat[np.repeat(starts[picked] - ends + sizes, sizes) + np.arange(sizes.sum())]
