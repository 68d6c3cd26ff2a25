"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance in km; NULL unless all four coordinates are known. NaN is unknown.

    The half-chord is clamped to 1 so that rounding never takes ``asin`` out of its domain.
    """
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_dphi = (phi2 - phi1) / 2
    half_dlambda = F.radians(lon2 - lon1) / 2
    chord = (
        F.sin(half_dphi) * F.sin(half_dphi)
        + F.cos(phi1) * F.cos(phi2) * F.sin(half_dlambda) * F.sin(half_dlambda)
    )
    # least() skips NULL and NaN, so the missing-coordinate case has to be spelled out
    return F.when(chord.isNotNull() & ~F.isnan(chord), 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(F.lit(1.0), chord))))
