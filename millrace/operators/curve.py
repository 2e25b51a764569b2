"""Order over several keys at once: their ranks' bits interleaved to one number.

Sorting by keys in turn keeps only the first one's values together. Along a space-filling curve rows
that are near in every key lie near each other, so a file covers a small range of each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 8  # of a key's rank, where the keys leave room
SAMPLE = 20_000  # rows, about, that the ranks are taken from; it bounds what comes to the driver


def quantiles(df: DataFrame, columns: list[str], rows: int, bits: int = BITS, seed: int = 17) -> dict[str, list]:
    """Values that cut each column into up to 2 ** bits parts of like size, by a sample of ``df``, which has ``rows`` rows."""
    share = min(1.0, SAMPLE / max(rows, 1))
    sampled = df.select(*columns) if share == 1.0 else df.select(*columns).sample(share, seed)
    found = sampled.limit(2 * SAMPLE).collect()
    cuts = {}
    for c in columns:
        values = sorted(r[c] for r in found if r[c] is not None and r[c] == r[c])
        cuts[c] = sorted({values[i * len(values) >> bits] for i in range(1, 1 << bits)}) if values else []
    return cuts


def rank(column: Column, cuts: list, bits: int = BITS) -> Column:
    """How many cuts are at or below a value, by halving; 0 for null."""
    if not cuts:
        return F.lit(0)
    known = F.array(*[F.lit(v) for v in cuts])
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    onward = lambda n, s: F.when(F.coalesce(F.get(known, n + s - 1) <= column, F.lit(False)), n + s).otherwise(n)
    return F.aggregate(steps, F.lit(0), onward)


def curve(df: DataFrame, columns: list[str], rows: int) -> Column:
    """One number per row: the bits of the columns' ranks, interleaved from the highest, the first column first.

    Seven columns get 8 bits each, more columns fewer. Nulls rank lowest, as do values below the first cut.
    """
    bits = min(BITS, 62 // len(columns))
    cuts = quantiles(df, columns, rows, bits)
    ranks = [rank(F.col(c), cuts[c], bits).cast("long") for c in columns]
    out = F.lit(0).cast("long")
    for b in range(bits):
        for i, r in enumerate(ranks):
            bit = F.shiftright(r, b).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(bit, b * len(columns) + len(columns) - 1 - i))
    return out
