"""Key hashes: reproducible randomness that does not depend on partitioning.

``rand`` and ``randomSplit`` draw per partition, so a different file layout gives a different split.
An md5 of the row's key gives the same answer on any cluster, and in any SQL engine.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def digest(columns: Iterable[str], seed: int | None = None) -> Column:
    parts = [] if seed is None else [F.lit(str(seed))]
    return F.md5(F.concat_ws(":", *parts, *[F.col(c).cast("string") for c in columns]))


def hex_window(hex_text: Column, start: int, length: int) -> Column:
    """``length`` hexadecimal digits from ``start`` (1-based) as a bigint."""
    return F.conv(F.substring(hex_text, start, length), 16, 10).cast("bigint")


def bucket52(columns: Iterable[str], domain: str, seed: int | None = None) -> Column:
    """Uniform bigint in [0, 2^52) from the key columns.

    ``domain`` names what the draw is for. Draws of different domains are independent, also with
    the same seed, so a sample can be split or folded.
    """
    prefix = domain if seed is None else f"{domain}:{seed}"
    parts = [F.lit(prefix), *[F.col(c).cast("string") for c in columns]]
    return hex_window(F.md5(F.concat_ws(":", *parts)), 1, 13)


def threshold(fraction: float) -> int:
    """The bucket below which a share of ``fraction`` lies; 52 bits resolve any fraction of use."""
    return round(fraction * (1 << 52))
