"""Hilbert keys of lon/lat boxes: near keys are near places, so sorted files hold small boxes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bits of each coordinate of a key; a key has twice as many.
BITS = 16
WORLD = (-180.0, -90.0, 180.0, 90.0)


def grid(value: Column, low: float, high: float, bits: int = BITS) -> Column:
    """The cell of a coordinate among 2^bits equal ones; values outside count in the outer cells, null and NaN give null."""
    cells = 1 << bits
    return F.when(value.isNotNull() & ~F.isnan(value), F.greatest(F.least(F.floor((value - low) / (high - low) * cells), F.lit(cells - 1)), F.lit(0)).cast("long"))


#: Bits of each coordinate that one look-up takes.
STEP = 4


def _table() -> list[int]:
    """For each state and STEP bits of x and of y: the state after them and their 2 * STEP bits of the key. A state tells whether coordinates are swapped (1) and complemented (2)."""
    out = []
    for state in range(4):
        for bits in range(1 << 2 * STEP):
            swap, flip, d = state & 1, state >> 1, 0
            for k in reversed(range(STEP)):
                x, y = bits >> STEP + k & 1, bits >> k & 1
                rx, ry = (y ^ flip, x ^ flip) if swap else (x ^ flip, y ^ flip)
                d = d * 4 + (ry if rx == 0 else 3 - ry)
                swap, flip = (swap, flip) if ry else (1 - swap, flip ^ rx)
            out.append((flip * 2 + swap) << 2 * STEP | d)
    return out


TABLE = _table()


def hilbert(x: Column, y: Column, bits: int = BITS) -> Column:
    """The place of a cell on the Hilbert curve through a square of 2^bits by 2^bits cells.

    A table gives the key's bits and the square's turn for STEP bits at a time, so the key is a few look-ups in compiled code.
    """
    steps = -(-bits // STEP)
    if (steps * STEP - bits) % 2:  # each leading zero of both swaps them
        x, y = y, x
    table = F.split(F.lit(",".join(map(str, TABLE))), ",").cast("array<int>")
    part = lambda v, k: F.shiftright(v.cast("long"), k * STEP).bitwiseAND(F.lit((1 << STEP) - 1))
    found, key = F.lit(0).cast("long"), F.lit(0).cast("long")
    for k in reversed(range(steps)):
        state = F.shiftright(found, 2 * STEP)
        found = F.get(table, (state * (1 << 2 * STEP) + part(x, k) * (1 << STEP) + part(y, k)).cast("int")).cast("long")
        key = key * (1 << 2 * STEP) + found.bitwiseAND(F.lit((1 << 2 * STEP) - 1))
    return key


def box_key(west: Column, south: Column, east: Column, north: Column, bits: int = BITS) -> Column:
    """The Hilbert key of a box's centre; null for boxes without one."""
    return hilbert(grid((west + east) / 2, WORLD[0], WORLD[2], bits), grid((south + north) / 2, WORLD[1], WORLD[3], bits), bits)
