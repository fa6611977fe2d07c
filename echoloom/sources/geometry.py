"""Field geometries: GeoJSON or WKT polygons to a bounding box and a centroid."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHAPE = "min_lon double, min_lat double, max_lon double, max_lat double, centroid_lon double, centroid_lat double"
_RING = re.compile(r"\(([^()]*)\)")


def rings_of(text: str | None) -> list[list[tuple[float, float]]]:
    """All rings of a polygon or multipolygon; empty if the text is neither."""
    text = (text or "").strip()
    try:
        if text[:1] == "{":
            shape = json.loads(text)
            shape = shape.get("geometry", shape)
            polygons = {"Polygon": lambda c: [c], "MultiPolygon": lambda c: c}[shape["type"]](shape["coordinates"])
            return [[(float(x), float(y)) for x, y, *_ in ring] for polygon in polygons for ring in polygon]
        if text.upper().startswith(("POLYGON", "MULTIPOLYGON")):
            return [[tuple(map(float, point.split()[:2])) for point in ring.split(",")] for ring in _RING.findall(text)]
    except (KeyError, TypeError, ValueError, AttributeError):
        pass
    return []


def measure(rings: list[list[tuple[float, float]]]) -> tuple:
    """Bounding box and area centroid; holes run the other way round and so count as less."""
    points = [p for ring in rings for p in ring]
    if not points or not all(abs(x) <= 180 and abs(y) <= 90 for x, y in points):
        return (None,) * 6
    xs, ys = [x for x, _ in points], [y for _, y in points]
    area = cx = cy = 0.0
    for ring in rings:
        for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1]):
            cross = x0 * y1 - x1 * y0
            area, cx, cy = area + cross, cx + (x0 + x1) * cross, cy + (y0 + y1) * cross
    centre = (cx / (3 * area), cy / (3 * area)) if abs(area) > 1e-15 else (sum(xs) / len(xs), sum(ys) / len(ys))
    return (min(xs), min(ys), max(xs), max(ys), *centre)


def with_shapes(df: DataFrame, column: str, least_valid: float = 0.95) -> DataFrame:
    """Adds box and centroid; fails if fewer than `least_valid` of the rows have a usable geometry."""
    names = [part.split()[0] for part in SHAPE.split(", ")]

    @F.pandas_udf(SHAPE)
    def shape(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(rings_of(t)) for t in text], columns=names)

    out = df.withColumn("__shape", shape(column)).select("*", *[F.col(f"__shape.{n}").alias(n) for n in names]).drop("__shape")
    valid, total = out.agg(F.count("centroid_lon"), F.count("*")).first()
    if total and valid < least_valid * total:
        raise ValueError(f"only {valid} of {total} geometries can be used")
    return out
