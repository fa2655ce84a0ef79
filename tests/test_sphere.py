"""Closeness, polygons and overlaps on the sphere against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.operators import sphere


def vec(ra, dec):
    a, d = np.radians(ra), np.radians(dec)
    return np.array([np.cos(d) * np.cos(a), np.cos(d) * np.sin(a), np.sin(d)])


@pytest.mark.parametrize("radius", [0.7, 8.0, 100.0])
def test_within_degrees_by_brute_force(spark, radius):
    rng = np.random.default_rng(2)
    a = [(i, float(r), float(d)) for i, (r, d) in enumerate(zip(rng.uniform(0, 360, 60), rng.uniform(-90, 90, 60)))] + [(60, 359.9, 0.0), (61, 10.0, 90.0), (62, 200.0, 89.7), (63, 0.0, -90.0), (64, None, 1.0)]
    b = [(i, r + 0.3 if r else 0.1, d) for i, r, d in a[::2]] + [(200, 0.1, 0.1), (201, 190.0, 89.9), (202, 1.0, None)]
    left, right = spark.createDataFrame(a, "a long, ra double, dec double"), spark.createDataFrame(b, "b long, other_ra double, other_dec double")
    found = {(r.a, r.b): r.distance for r in sphere.within_degrees(left, right, radius).collect()}
    angle = lambda p, q: np.degrees(2 * np.arcsin(min(1, np.linalg.norm(vec(*p) - vec(*q)) / 2)))
    expected = {(i, j): angle((r, d), (s, e)) for i, r, d in a for j, s, e in b if None not in (r, d, s, e) and angle((r, d), (s, e)) <= radius}
    assert found.keys() == expected.keys() and all(abs(found[k] - v) < 1e-9 for k, v in expected.items()) and (radius < 1 or (60, 200) in found)
    with pytest.raises(ValueError):
        sphere.within_degrees(left, right, 0.0)


def square(ra, dec, half):
    """Corners of a square about a position, by turning a square about (0, 0)."""
    a, d = np.radians(ra), np.radians(dec)
    east, north, out = np.array([-np.sin(a), np.cos(a), 0]), np.array([-np.sin(d) * np.cos(a), -np.sin(d) * np.sin(a), np.cos(d)]), vec(ra, dec)
    t = np.tan(np.radians(half))
    corners = []
    for x, y in ((-1, -1), (1, -1), (1, 1), (-1, 1)):
        v = out + t * (x * east + y * north)
        v /= np.linalg.norm(v)
        corners.append((float(np.degrees(np.arctan2(v[1], v[0])) % 360), float(np.degrees(np.arcsin(v[2])))))
    return corners


CORNERS = "array<struct<ra:double,dec:double>>"


def test_positions_in_polygons(spark):
    rng = np.random.default_rng(1)
    rows = []
    for ra, dec in ((0.0, 0.0), (359.95, 40.0), (123.0, 90.0), (10.0, -89.9)):
        for _ in range(30):
            x, y = rng.uniform(-2, 2, 2)
            a, d = np.radians(ra), np.radians(dec)
            v = vec(ra, dec) + np.tan(np.radians(1)) * (x * np.array([-np.sin(a), np.cos(a), 0]) + y * np.array([-np.sin(d) * np.cos(a), -np.sin(d) * np.sin(a), np.cos(d)]))
            v /= np.linalg.norm(v)
            p = float(np.degrees(np.arctan2(v[1], v[0])) % 360), float(np.degrees(np.arcsin(v[2])))
            corners = square(ra, dec, 1.0)
            rows.append((*p, corners[:: 1 if len(rows) % 2 else -1], bool(abs(x) <= 1 and abs(y) <= 1)))
            rows.append(((p[0] + 180) % 360, -p[1], corners, False))
    df = spark.createDataFrame(rows, f"ra double, dec double, corners {CORNERS}, inside boolean")
    assert df.where(sphere.in_polygon(F.col("ra"), F.col("dec"), F.col("corners")) != F.col("inside")).count() == 0


def test_clipping_of_boxes(spark):
    rng = np.random.default_rng(3)
    box = lambda x0, y0, x1, y1: [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    rows = []
    for _ in range(60):
        (ax, bx), (ay, by), (cx, dx), (cy, dy) = (sorted(rng.uniform(0, 10, 2).tolist()) for _ in range(4))
        expected = max(0.0, min(bx, dx) - max(ax, cx)) * max(0.0, min(by, dy) - max(ay, cy))
        rows.append((box(ax, ay, bx, by), box(cx, cy, dx, dy)[:: rng.choice([1, -1])], expected))
    rows.append(([(0.0, 0.0), (4.0, 0.0), (0.0, 4.0)], box(1.0, 1.0, 9.0, 9.0), 2.0))
    df = spark.createDataFrame(rows, "p array<struct<x:double,y:double>>, w array<struct<x:double,y:double>>, expected double")
    assert df.where(F.abs(F.abs(sphere.area(sphere.clipped(F.col("p"), F.col("w")))) - F.col("expected")) > 1e-9).count() == 0


@pytest.mark.parametrize("ra,dec", [(150.0, 20.0), (0.05, -60.0), (77.0, 89.9)])
def test_best_cells_for_padding(spark, ra, dec):
    """Cells side by side: one covers a region, two share another, a third lies at an edge, a fourth alone."""
    a, d = np.radians(ra), np.radians(dec)
    east, north = np.array([-np.sin(a), np.cos(a), 0]), np.array([-np.sin(d) * np.cos(a), -np.sin(d) * np.sin(a), np.cos(d)])

    def corners(x, y, hx, hy):
        out = []
        for sx, sy in ((-1, -1), (1, -1), (1, 1), (-1, 1)):
            v = vec(ra, dec) + np.radians(x + sx * hx) * east + np.radians(y + sy * hy) * north
            v /= np.linalg.norm(v)
            out.append((float(np.degrees(np.arctan2(v[1], v[0])) % 360), float(np.degrees(np.arcsin(v[2])))))
        return out

    cells = [("own", corners(0, -0.4, 0.2, 0.2)), ("full", corners(0, 0, 0.2, 0.2)), ("right", corners(0.4, 0, 0.2, 0.2)), ("far", corners(3, 3, 0.2, 0.2))]
    regions = [("inside", "own", corners(0.05, 0.05, 0.1, 0.1)), ("shared", "own", corners(0.18, 0.0, 0.1, 0.1)), ("edge", "own", corners(0, 0.2, 0.1, 0.1)), ("itself", "own", corners(0, -0.4, 0.02, 0.02)), ("lost", "own", corners(-2, 0, 0.1, 0.1))]
    found = {r.region: r for r in sphere.best_padding(spark.createDataFrame(regions, f"region string, target string, corners {CORNERS}"), spark.createDataFrame(cells, f"cell string, corners {CORNERS}")).collect()}
    assert {k: (r.status, r.best) for k, r in found.items()} == {"inside": ("full_coverage", "full"), "shared": ("combined_coverage", "full"), "edge": ("partial_coverage", "full"), "itself": ("no_overlap", None), "lost": ("no_overlap", None)}
    assert abs(found["inside"].coverage - 100) < 1e-6 and abs(found["shared"].coverage - 60) < 0.01 and abs(found["edge"].coverage - 50) < 0.01
    (pair,) = found["shared"].pairs
    assert (pair.a, pair.b) == ("full", "right") and abs(pair.coverage - 100) < 1e-6 and abs(pair.mean_distance - (0.18 + 0.22) / 2) < 1e-3
