"""Seeded hash keys: repeatable stand-ins for random order and random fractions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadlens.functions.text import _col


def order_key(key: Column | str, seed: int) -> Column:
    """Hex digest of key and seed; sorting by it is a fixed random order."""
    return F.md5(F.concat(_col(key).cast("string"), F.lit(f"|{seed}")))


def below_fraction(key: Column | str, fraction: float, seed: int) -> Column:
    """True for about `fraction` of the keys, always the same ones for one seed."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie in [0, 1]")
    if fraction == 1.0:
        return F.lit(True)
    return F.substring(order_key(key, seed), 1, 8) < F.lit(format(int(fraction * 2**32), "08x"))
