"""Keyed pseudonyms: HMAC-SHA-256 as native column expressions.

The key never appears in a plan. ``keyed`` attaches the two key blocks as hidden
columns read by scalar subqueries, so plans and event logs show only the subquery
ids; ``hashed`` builds on those columns and stays in generated code.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY_VARIABLE = "HMAC_KEY"
INNER = "_inner_block"
OUTER = "_outer_block"
BLOCK_BYTES = 64
PSEUDONYM_PATTERN = "^[0-9a-f]{64}$"

AnonFunc = Callable[[Column], Column]


def key_bytes(key: str | bytes | None = None) -> bytes:
    """The key from a hex string, raw bytes or the environment."""
    if key is None:
        key = os.environ[KEY_VARIABLE]
    return bytes.fromhex(key) if isinstance(key, str) else bytes(key)


def key_blocks(key: str | bytes | None = None) -> tuple[bytearray, bytearray]:
    raw = key_bytes(key)
    if len(raw) > BLOCK_BYTES:
        raw = hashlib.sha256(raw).digest()
    raw = raw.ljust(BLOCK_BYTES, b"\0")
    return bytearray(b ^ 0x36 for b in raw), bytearray(b ^ 0x5C for b in raw)


def keyed(df: DataFrame, key: str | bytes | None = None) -> DataFrame:
    """``df`` with the key blocks attached; ``hashed`` works on the result."""
    blocks = df.sparkSession.createDataFrame(
        [key_blocks(key)], "inner_block binary, outer_block binary"
    )
    return df.withColumns(
        {
            INNER: blocks.select("inner_block").scalar(),
            OUTER: blocks.select("outer_block").scalar(),
        }
    )


def unkeyed(df: DataFrame) -> DataFrame:
    return df.drop(INNER, OUTER)


def hashed(value: Column) -> Column:
    """Lower-case hex HMAC-SHA-256 of the text form of ``value``; null stays null."""
    data = value.cast("string").cast("binary")
    inner = F.unhex(F.sha2(F.concat(F.col(INNER), data), 256))
    return F.sha2(F.concat(F.col(OUTER), inner), 256)


def looks_hashed(value: Column) -> Column:
    return F.coalesce(value.cast("string").rlike(PSEUDONYM_PATTERN), F.lit(False))


def hashed_once(value: Column) -> Column:
    """Hash unless the value already has the form of a pseudonym.

    The cheap, join-free variant of ``operators.pseudonyms.safe_anonymise``.
    """
    return F.when(looks_hashed(value), value.cast("string")).otherwise(hashed(value))
