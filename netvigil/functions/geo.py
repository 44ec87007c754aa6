"""Geohash cells as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the geohash alphabet.
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def _scaled(degrees: Column, span: int, bits: int) -> Column:
    """Degrees as an integer of ``bits`` bits; the upper edge belongs to the last cell."""
    cells = 1 << bits
    scaled = F.floor((degrees + F.lit(span / 2)) / F.lit(float(span)) * F.lit(float(cells)))
    return F.least(scaled.cast("bigint"), F.lit(cells - 1).cast("bigint"))


def geohash(lat: Column, lon: Column, precision: int) -> Column:
    """Geohash of ``precision`` characters (1 to 12); bits alternate, longitude first."""
    bits = 5 * precision
    lon_bits, lat_bits = (bits + 1) // 2, bits // 2
    x, y = _scaled(lon, 360, lon_bits), _scaled(lat, 180, lat_bits)

    def bit(position: int) -> Column:
        source, width = (x, lon_bits) if position % 2 == 0 else (y, lat_bits)
        return F.shiftright(source, width - 1 - position // 2).bitwiseAND(F.lit(1).cast("bigint"))

    characters = []
    for start in range(0, bits, 5):
        index = F.lit(1).cast("bigint")
        for offset in range(5):
            index = index + F.shiftleft(bit(start + offset), 4 - offset)
        characters.append(F.substring(F.lit(GEOHASH_ALPHABET), index.cast("int"), F.lit(1)))
    return F.concat(*characters)
