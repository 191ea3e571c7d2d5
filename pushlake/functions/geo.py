"""Coordinate-system conversion between WGS-84, GCJ-02 and BD-09.

All functions are Column expressions over (lng, lat) Columns and return a
``struct<lng:double,lat:double>``; no Python UDF. Argument order is always
(lng, lat). NaN coordinates should be filtered first (D11).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pushlake.functions._cols import ColumnOrName, as_col

# Fixed values of the published GCJ-02 / BD-09 conversion:
#   PI     = 3.1415926535897932384626
#   X_PI   = 3.14159265358979324 * 3000.0 / 180.0
#   A      = 6378245.0                (semi-major axis)
#   EE     = 0.00669342162296594323   (eccentricity squared)
#   box    = lng in [72.004, 137.8347], lat in [0.8293, 55.8271]
#   BD-09 offsets 0.0065 (lng), 0.006 (lat); terms 0.00002 and 0.000003
PI = 3.1415926535897932384626
X_PI = 3.14159265358979324 * 3000.0 / 180.0
A = 6378245.0
EE = 0.00669342162296594323
LNG_MIN, LNG_MAX = 72.004, 137.8347
LAT_MIN, LAT_MAX = 0.8293, 55.8271


def _pt(lng: Column, lat: Column) -> Column:
    return F.struct(lng.alias("lng"), lat.alias("lat"))


def out_of_china(lng: ColumnOrName, lat: ColumnOrName) -> Column:
    """Outside the box (its edges are inside)."""
    x, y = as_col(lng), as_col(lat)
    return (x < LNG_MIN) | (x > LNG_MAX) | (y < LAT_MIN) | (y > LAT_MAX)


def transform_lat(x: Column, y: Column) -> Column:
    """Latitude offset series at (x, y) = (lng - 105, lat - 35)."""
    ret = F.lit(-100.0) + 2.0 * x + 3.0 * y + 0.2 * y * y + 0.1 * x * y + 0.2 * F.sqrt(F.abs(x))
    ret = ret + (20.0 * F.sin(6.0 * x * PI) + 20.0 * F.sin(2.0 * x * PI)) * 2.0 / 3.0
    ret = ret + (20.0 * F.sin(y * PI) + 40.0 * F.sin(y / 3.0 * PI)) * 2.0 / 3.0
    ret = ret + (160.0 * F.sin(y / 12.0 * PI) + 320 * F.sin(y * PI / 30.0)) * 2.0 / 3.0
    return ret


def transform_lng(x: Column, y: Column) -> Column:
    """Longitude offset series at (x, y) = (lng - 105, lat - 35)."""
    ret = F.lit(300.0) + x + 2.0 * y + 0.1 * x * x + 0.1 * x * y + 0.1 * F.sqrt(F.abs(x))
    ret = ret + (20.0 * F.sin(6.0 * x * PI) + 20.0 * F.sin(2.0 * x * PI)) * 2.0 / 3.0
    ret = ret + (20.0 * F.sin(x * PI) + 40.0 * F.sin(x / 3.0 * PI)) * 2.0 / 3.0
    ret = ret + (150.0 * F.sin(x / 12.0 * PI) + 300.0 * F.sin(x / 30.0 * PI)) * 2.0 / 3.0
    return ret


def _shift(lng: Column, lat: Column) -> tuple[Column, Column]:
    """The GCJ-02 offset (dlng, dlat) at a point."""
    dlat = transform_lat(lng - 105.0, lat - 35.0)
    dlng = transform_lng(lng - 105.0, lat - 35.0)
    radlat = lat / 180.0 * PI
    magic = 1 - EE * F.sin(radlat) * F.sin(radlat)
    sqrtmagic = F.sqrt(magic)
    dlat = (dlat * 180.0) / ((A * (1 - EE)) / (magic * sqrtmagic) * PI)
    dlng = (dlng * 180.0) / (A / sqrtmagic * F.cos(radlat) * PI)
    return dlng, dlat


def wgs84_to_gcj02(lng: ColumnOrName, lat: ColumnOrName) -> Column:
    """WGS-84 -> GCJ-02; identity outside the box."""
    x, y = as_col(lng), as_col(lat)
    dlng, dlat = _shift(x, y)
    out = out_of_china(x, y)
    return _pt(F.when(out, x).otherwise(x + dlng), F.when(out, y).otherwise(y + dlat))


def gcj02_to_wgs84(lng: ColumnOrName, lat: ColumnOrName) -> Column:
    """GCJ-02 -> WGS-84 as ``2 p - shift(p)`` (one-step approximate inverse)."""
    x, y = as_col(lng), as_col(lat)
    dlng, dlat = _shift(x, y)
    out = out_of_china(x, y)
    return _pt(
        F.when(out, x).otherwise(x * 2 - (x + dlng)),
        F.when(out, y).otherwise(y * 2 - (y + dlat)),
    )


def gcj02_to_bd09(lng: ColumnOrName, lat: ColumnOrName) -> Column:
    """GCJ-02 -> BD-09."""
    x, y = as_col(lng), as_col(lat)
    z = F.sqrt(x * x + y * y) + 0.00002 * F.sin(y * X_PI)
    theta = F.atan2(y, x) + 0.000003 * F.cos(x * X_PI)
    return _pt(z * F.cos(theta) + 0.0065, z * F.sin(theta) + 0.006)


def bd09_to_gcj02(lng: ColumnOrName, lat: ColumnOrName) -> Column:
    """G1: BD-09 -> GCJ-02."""
    x = as_col(lng) - 0.0065
    y = as_col(lat) - 0.006
    z = F.sqrt(x * x + y * y) - 0.00002 * F.sin(y * X_PI)
    theta = F.atan2(y, x) - 0.000003 * F.cos(x * X_PI)
    return _pt(z * F.cos(theta), z * F.sin(theta))


def bd09_to_wgs84(lng: ColumnOrName, lat: ColumnOrName) -> Column:
    """BD-09 -> GCJ-02 -> WGS-84."""
    g = bd09_to_gcj02(lng, lat)
    return gcj02_to_wgs84(g["lng"], g["lat"])


def wgs84_to_bd09(lng: ColumnOrName, lat: ColumnOrName) -> Column:
    """WGS-84 -> GCJ-02 -> BD-09."""
    g = wgs84_to_gcj02(lng, lat)
    return gcj02_to_bd09(g["lng"], g["lat"])
