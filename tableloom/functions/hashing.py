"""Keyed pseudonymisation of a text column (HMAC-SHA256), built-ins only."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

_SHA256_BLOCK_BYTES = 64


def _pad(key: bytes, filler: int) -> Column:
    padded = key.ljust(_SHA256_BLOCK_BYTES, b"\0")
    return F.lit(bytearray(byte ^ filler for byte in padded))


def keyed_hash(value: Column, salt: str) -> Column:
    """Lower-case hex HMAC-SHA256 of ``value`` under ``salt``; null stays null."""
    key = salt.encode("utf-8")
    if len(key) > _SHA256_BLOCK_BYTES:
        key = hashlib.sha256(key).digest()
    inner = F.sha2(F.concat(_pad(key, 0x36), F.encode(value, "UTF-8")), 256)
    return F.sha2(F.concat(_pad(key, 0x5C), F.unhex(inner)), 256)


def matches_hash(value: Column, stored: Column | str, salt: str) -> Column:
    """True where ``value`` hashes to ``stored``."""
    if isinstance(stored, str):
        stored = F.lit(stored)
    return keyed_hash(value, salt) == stored
