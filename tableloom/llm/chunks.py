"""Fingerprints of texts as sets of content-defined chunks.

A gear hash runs over the UTF-8 bytes and cuts where its low bits are zero, so a
cut depends on the 32 bytes before it and not on the position. Cutting is
normalised: a chunk shorter than the usual size needs more zero bits than a
longer one. A fingerprint is the sorted set of chunk digests. One token holds
56 bits of digest and 8 bits of length; the length is its weight when the
containment of one fingerprint in another is measured.
"""

from __future__ import annotations

import numpy as np
import xxhash

#: Fixed values of the cutting: sizes in bytes, zero bits before and after USUAL.
SHORTEST, USUAL, LONGEST = 16, 48, 255
STRICT, LOOSE = np.uint32(0x7F << 25), np.uint32(0x1F << 25)
REACH = 32
#: Bytes hashed at once; bounds the memory of very long texts.
SLICE = 1 << 20


def gear_table() -> np.ndarray:
    """One 32-bit number for every byte value."""
    made = [xxhash.xxh32_intdigest(bytes([value]), seed=2024) for value in range(256)]
    return np.array(made, dtype=np.uint32)


GEAR = gear_table()


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """At each byte the sum of GEAR over the last 32 bytes, each shifted by its distance."""
    sums = GEAR[data]
    width = 1
    while width < REACH:
        shifted = sums.copy()
        shifted[width:] += sums[:-width] << np.uint32(width)
        sums, width = shifted, 2 * width
    return sums


def cut_places(data: bytes) -> list[tuple[int, bool]]:
    """Ends of possible chunks and whether they meet the strict condition."""
    found = []
    for start in range(0, len(data), SLICE):
        ahead = min(start, REACH)
        part = np.frombuffer(data[start - ahead : start + SLICE], dtype=np.uint8)
        sums = gear_hashes(part)[ahead:]
        places = np.flatnonzero((sums & LOOSE) == 0)
        strict = (sums[places] & STRICT) == 0
        found += zip((places + start + 1).tolist(), strict.tolist(), strict=True)
    return found


def chunk_ends(data: bytes) -> list[int]:
    ends, begun = [], 0
    for place, strict in cut_places(data):
        while place - begun > LONGEST:
            begun += LONGEST
            ends.append(begun)
        size = place - begun
        if size >= SHORTEST and (strict or size >= USUAL):
            ends.append(place)
            begun = place
    while len(data) - begun > LONGEST:
        begun += LONGEST
        ends.append(begun)
    if begun < len(data):
        ends.append(len(data))
    return ends


def chunk_tokens(text: str) -> np.ndarray:
    """Sorted distinct tokens; none for the empty text."""
    data = text.encode("utf-8", "replace")
    tokens, begun = [], 0
    for end in chunk_ends(data):
        digest = xxhash.xxh64_intdigest(data[begun:end])
        tokens.append((digest & ~0xFF) | (end - begun))
        begun = end
    return np.unique(np.array(tokens, dtype=np.uint64))


def weight(tokens: np.ndarray) -> int:
    return int((tokens & np.uint64(0xFF)).sum())


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the weight of ``a`` that ``b`` has too; 1 for two empty sets, 0 for one."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return weight(np.intersect1d(a, b, assume_unique=True)) / weight(a)


def rendered(tokens: np.ndarray) -> str:
    """The tokens as 16 hex digits each."""
    return tokens.astype(">u8").tobytes().hex()


def parsed(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), dtype=">u8").astype(np.uint64)
