"""Pixel and sky geometry: linear tangent-plane maps, crops, grids, masks of flags."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.functions import scalars

#: The bits of a pixel's quality mask, and whole values with a meaning of their own.
MASK_BITS = {
    "DETECTOR": 1, "FLAT": 2, "DARK": 4, "BLANK": 8, "CTE": 16, "SAT": 32, "LOW": 64, "SUSPECT": 128, "BURNTOOL": 128, "CR": 256,
    "SPIKE": 512, "GHOST": 1024, "STREAK": 2048, "STARCORE": 4096, "CONV.BAD": 8192, "CONV.POOR": 16384,
}
MASK_VALUES = {"MASK.VALUE": 8575, "MARK.VALUE": 32768}


class Tan:
    """A linear map of pixels to a tangent plane about (ra0, dec0), from literals or columns."""

    def __init__(self, ra0, dec0, x0, y0, pc: Sequence, steps: Sequence) -> None:
        lift = lambda v: v if isinstance(v, Column) else F.lit(float(v))
        self.ra0, self.dec0, self.x0, self.y0 = map(lift, (ra0, dec0, x0, y0))
        self.pc, self.steps = [lift(v) for v in pc], [lift(v) for v in steps]

    def plane(self, x: Column, y: Column) -> tuple[Column, Column]:
        dx, dy = x - self.x0, y - self.y0
        return self.steps[0] * (self.pc[0] * dx + self.pc[1] * dy), self.steps[1] * (self.pc[2] * dx + self.pc[3] * dy)

    def sky(self, x: Column, y: Column) -> tuple[Column, Column]:
        """(ra, dec) in degrees of a pixel counted from the reference pixel's origin."""
        return scalars.inverse_tangent_plane_at(*self.plane(x, y), self.ra0, self.dec0)

    def corners(self, nx: Column, ny: Column, left, right, low, high) -> Column:
        """Array of struct(ra, dec) of the four corners of nx x ny pixels, each side moved out by its buffer."""
        points = [(-left, -low), (nx + right, -low), (nx + right, ny + high), (-left, ny + high)]
        sky = [self.sky(F.lit(0) + x, F.lit(0) + y) for x, y in points]
        return F.array(*(F.struct(ra.alias("ra"), dec.alias("dec")) for ra, dec in sky))

    def centre(self, nx: Column, ny: Column) -> tuple[Column, Column]:
        return self.sky(F.floor(nx / 2).cast("double"), F.floor(ny / 2).cast("double"))


def edge_buffers(cell: Column, large: float, small: float, normal: float, last: int = 9) -> tuple[Column, Column]:
    """(before, after) for a cell's place in a row of cells: large outside, small next to an edge's cell, else normal."""
    before = F.when(cell == 0, large).when(cell == last, small).otherwise(normal)
    after = F.when(cell == last, large).when(cell == 0, small).otherwise(normal)
    return before, after


def shift_to_middle(ra: Column, reference: Column) -> Column:
    """Right ascension moved so that the reference stands at 180 and nothing near it wraps."""
    return scalars.wrap_degrees(ra + (F.lit(180.0) - reference))


def cd_matrix(cd: Sequence[Column], pc: Sequence[Column], steps: Sequence[Column], default: float) -> Column:
    """struct(cd11, cd12, cd21, cd22): given, or steps times PC, or the default on the diagonal."""
    names = ("cd11", "cd12", "cd21", "cd22")
    known = lambda cols: F.array_size(F.filter(F.array(*cols), lambda v: v.isNull())) == 0
    product = [steps[i // 2] * pc[i] for i in range(4)]
    plain = [F.lit(default), F.lit(0.0), F.lit(0.0), F.lit(default)]
    build = lambda cols: F.struct(*(c.cast("double").alias(n) for c, n in zip(cols, names)))
    return F.when(known(cd), build(cd)).when(known([*pc, *steps]), build(product)).otherwise(build(plain))


def crop_box(nx: Column, ny: Column, mode: Column, edges: Sequence[Column], left: int = 44, right: int = 44, top: int = 30) -> Column:
    """struct(x_min, x_max, y_min, y_max), half open and inside the chip; null for an unknown mode or an empty box.

    `edges` (in that order) decide if one of them is known, the others then lying at the usable area; else the mode does: full,
    or a quarter of the usable area: tl, tr, bl, br.
    """
    lo_x, hi_x, lo_y, hi_y = F.lit(left), nx - right, F.lit(0), ny - top
    mid_x, mid_y = F.floor(nx / 2).cast("int"), F.floor(ny / 2).cast("int")
    quarter = mode.isin("tl", "tr", "bl", "br")
    at_right, at_top, full = mode.endswith("r"), mode.startswith("t"), mode == "full"
    given = F.coalesce(*edges).isNotNull()
    by_mode = (
        F.when(full, 0).when(at_right, F.greatest(lo_x, mid_x)).otherwise(lo_x),
        F.when(full, nx).when(at_right, hi_x).otherwise(F.least(hi_x, mid_x)),
        F.when(full, 0).when(at_top, F.greatest(lo_y, mid_y)).otherwise(lo_y),
        F.when(full, ny).when(at_top, hi_y).otherwise(F.least(hi_y, mid_y)),
    )
    box = [F.when(given, F.coalesce(e, usable)).otherwise(m) for e, usable, m in zip(edges, (lo_x, hi_x, lo_y, hi_y), by_mode)]
    box = [
        F.greatest(F.lit(0), F.least(box[0], nx - 1)), F.greatest(F.lit(1), F.least(box[1], nx)),
        F.greatest(F.lit(0), F.least(box[2], ny - 1)), F.greatest(F.lit(1), F.least(box[3], ny)),
    ]
    names = ("x_min", "x_max", "y_min", "y_max")
    sound = (given | full | quarter) & (box[0] < box[1]) & (box[2] < box[3])
    return F.when(sound, F.struct(*(b.cast("int").alias(n) for b, n in zip(box, names))))


def target_box(nx: Column, ny: Column, cx: Column, cy: Column, size: int) -> Column:
    """struct(x_min, x_max, y_min, y_max) of a square about (cx, cy), moved so that it stays on the chip."""

    def side(n: Column, c: Column) -> tuple[Column, Column]:
        low = F.greatest(c - size // 2, F.lit(0))
        high = low + size
        over = F.greatest(high - n, F.lit(0))
        low = F.greatest(low - over, F.lit(0))
        return low, F.least(n, F.greatest(high - over, low + 1))

    (x0, x1), (y0, y1) = side(nx, cx), side(ny, cy)
    return F.struct(*(v.cast("int").alias(k) for k, v in (("x_min", x0), ("x_max", x1), ("y_min", y0), ("y_max", y1))))


def inside_box(x: Column, y: Column, box: Column) -> Column:
    return (x >= box["x_min"]) & (x < box["x_max"]) & (y >= box["y_min"]) & (y < box["y_max"])


def box_within(inner: Column, outer: Column) -> Column:
    """Does the outer box hold the inner one?"""
    return (inner["x_min"] >= outer["x_min"]) & (inner["x_max"] <= outer["x_max"]) & (inner["y_min"] >= outer["y_min"]) & (inner["y_max"] <= outer["y_max"])


def strictly_inside(x: Column, y: Column, nx: int, ny: int) -> Column:
    return (x > 0) & (x < nx - 1) & (y > 0) & (y < ny - 1)


def detector_edge(x: Column, y: Column, nx: int, ny: int, left: int = 44, right: int = 44, top: int = 30) -> Column:
    """Chip columns and rows without science pixels; x and y count from the chip's corner."""
    return (x < left) | (x >= nx - right) | (y >= ny - top)


def mask_flags(mask: Column) -> Column:
    """Names of a mask's flags; a whole value of its own has that one name."""
    bits = F.array(*(F.when(mask.bitwiseAND(F.lit(b)) != 0, F.lit(n)) for n, b in MASK_BITS.items()))
    special = F.lit(None)
    for name, value in MASK_VALUES.items():
        special = F.when(mask == value, F.array(F.lit(name))).otherwise(special)
    return F.coalesce(special, F.array_compact(bits))


def mask_of_flags(flags: Column) -> Column:
    """The mask of named flags; the first name of a whole value decides alone; unknown names count nothing."""
    bits = F.create_map(*(F.lit(v) for kv in MASK_BITS.items() for v in kv))
    whole = F.create_map(*(F.lit(v) for kv in MASK_VALUES.items() for v in kv))
    special = F.get(F.filter(F.transform(flags, lambda f: whole[f]), lambda v: v.isNotNull()), F.lit(0))
    return F.coalesce(special, F.aggregate(flags, F.lit(0), lambda a, f: a.bitwiseOR(F.coalesce(bits[f], F.lit(0)))))


def clear_bit(mask: Column, bit: int = 5) -> Column:
    return mask.bitwiseAND(F.lit(~(1 << bit)))


def odd_window(n: Column) -> Column:
    """At least 3, and the next odd number from even ones."""
    whole = F.greatest(n.cast("int"), F.lit(3))
    return F.when(whole % 2 == 0, whole + 1).otherwise(whole)


def polynomial(x: Column, y: Column, coefficients: Sequence[float], order: int) -> Column:
    """Sum of c x^i y^j over i + j <= order, i slowest."""
    powers = [(i, j) for i in range(order + 1) for j in range(order + 1 - i)]
    out = F.lit(0.0)
    for c, (i, j) in zip(coefficients, powers, strict=True):
        out = out + F.lit(float(c)) * F.pow(x, F.lit(i)) * F.pow(y, F.lit(j))
    return out


def grid(nx: int, ny: int, over: int = 1) -> Column:
    """Array of struct(x, y) of pixel centres, `over` of them to each side's pixel; to be exploded."""
    at = lambda n: F.transform(F.sequence(F.lit(0), F.lit(n * over - 1)), lambda i: (i + 0.5) / over - 0.5)
    return F.flatten(F.transform(at(ny), lambda y: F.transform(at(nx), lambda x: F.struct(x.alias("x"), y.alias("y")))))


def tangent_plane(ra: Column, dec: Column, ra0: float, dec0: float) -> tuple[Column, Column]:
    """Plane offsets in degrees of a sky position; null on the far side."""
    a, d, a0, d0 = (ra - ra0) * scalars.RAD, dec * scalars.RAD, 0.0, dec0 * scalars.RAD
    cosine = F.sin(F.lit(d0)) * F.sin(d) + F.cos(F.lit(d0)) * F.cos(d) * F.cos(a - a0)
    x = F.cos(d) * F.sin(a) / cosine / scalars.RAD
    y = (F.cos(F.lit(d0)) * F.sin(d) - F.sin(F.lit(d0)) * F.cos(d) * F.cos(a)) / cosine / scalars.RAD
    return F.when(cosine > 0, x), F.when(cosine > 0, y)


def pixel(ra: Column, dec: Column, ra0: float, dec0: float, x0: float, y0: float, cd: Sequence[float]) -> tuple[Column, Column]:
    """Pixel of a sky position through the inverse of a CD matrix (four numbers by row)."""
    u, v = tangent_plane(ra, dec, ra0, dec0)
    det = cd[0] * cd[3] - cd[1] * cd[2]
    return (cd[3] * u - cd[1] * v) / det + x0, (cd[0] * v - cd[2] * u) / det + y0


#: A frame's map between sky and pixels: the tangent point in degrees, its pixel (from 0), the matrix by row, and the terms of the
#: distortion, c u^p v^q of the offsets u and v from that pixel, that are added to u (`a`) and to v (`b`).
SKY_MAP = "struct<ra0:double,dec0:double,x0:double,y0:double,cd:array<double>,a:array<struct<p:int,q:int,c:double>>,b:array<struct<p:int,q:int,c:double>>>"


def separation(ra1: float, dec1: float, ra2: float, dec2: float) -> float:
    """Degrees between two positions."""
    a1, d1, a2, d2 = (math.radians(v) for v in (ra1, dec1, ra2, dec2))
    h = math.sin((d2 - d1) / 2) ** 2 + math.cos(d1) * math.cos(d2) * math.sin((a2 - a1) / 2) ** 2
    return math.degrees(2 * math.asin(min(1.0, math.sqrt(h))))


def _term_sums(terms: Column, u: Column, v: Column) -> Column:
    """struct(f, fu, fv): the terms' sum and its slopes; no terms count 0."""
    power = lambda x, n: F.when(n == 0, F.lit(1.0)).otherwise(F.pow(x, n))
    slope = lambda x, n: F.when(n == 0, F.lit(0.0)).when(n == 1, F.lit(1.0)).otherwise(n * F.pow(x, n - 1))
    start = F.struct(F.lit(0.0).alias("f"), F.lit(0.0).alias("fu"), F.lit(0.0).alias("fv"))

    def add(s: Column, t: Column) -> Column:
        pu, pv = power(u, t["p"]), power(v, t["q"])
        return F.struct((s["f"] + t["c"] * pu * pv).alias("f"), (s["fu"] + t["c"] * slope(u, t["p"]) * pv).alias("fu"), (s["fv"] + t["c"] * pu * slope(v, t["q"])).alias("fv"))

    return F.aggregate(F.coalesce(terms, F.array().cast("array<struct<p:int,q:int,c:double>>")), start, add)


def sky_to_pixel(ra: Column, dec: Column, sky_map: Column, steps: int = 8) -> tuple[Column, Column]:
    """Pixel of a sky position through a frame's own map; null on the far side of the sky or without a map.

    The distortion is undone by Newton steps of a fixed number, which double the right digits each.
    """
    at, cd = tangent_plane_of(ra, dec, sky_map["ra0"], sky_map["dec0"]), sky_map["cd"]
    det = cd[0] * cd[3] - cd[1] * cd[2]
    goal_u, goal_v = (cd[3] * at[0] - cd[1] * at[1]) / det, (cd[0] * at[1] - cd[2] * at[0]) / det

    def step(goal: Column, s: Column) -> Column:
        def move(t: Column) -> Column:
            a, b = t["a"], t["b"]
            du, dv = s["u"] + a["f"] - goal["u"], s["v"] + b["f"] - goal["v"]
            uu, uv, vu, vv = 1 + a["fu"], a["fv"], b["fu"], 1 + b["fv"]
            d = uu * vv - uv * vu
            return F.struct((s["u"] - (vv * du - uv * dv) / d).alias("u"), (s["v"] - (uu * dv - vu * du) / d).alias("v"))

        sums = F.struct(_term_sums(sky_map["a"], s["u"], s["v"]).alias("a"), _term_sums(sky_map["b"], s["u"], s["v"]).alias("b"))
        return scalars.bound(sums, move)

    start = F.struct(goal_u.alias("u"), goal_v.alias("v"))
    found = scalars.bound(start, lambda goal: F.aggregate(F.sequence(F.lit(1), F.lit(steps)), goal, lambda s, _: step(goal, s)))
    return found["u"] + sky_map["x0"], found["v"] + sky_map["y0"]


def tangent_plane_of(ra: Column, dec: Column, ra0: Column, dec0: Column) -> tuple[Column, Column]:
    """As `tangent_plane`, about a point that differs by row."""
    a, d, d0 = F.radians(ra - ra0), F.radians(dec), F.radians(dec0)
    cosine = F.sin(d0) * F.sin(d) + F.cos(d0) * F.cos(d) * F.cos(a)
    x, y = F.degrees(F.cos(d) * F.sin(a) / cosine), F.degrees((F.cos(d0) * F.sin(d) - F.sin(d0) * F.cos(d) * F.cos(a)) / cosine)
    return F.when(cosine > 0, x), F.when(cosine > 0, y)


def pixel_to_sky(x: Column, y: Column, sky_map: Column) -> tuple[Column, Column]:
    """Sky position (degrees, ra from 0 to 360) of a pixel through a frame's own map."""
    u, v, cd, d0 = x - sky_map["x0"], y - sky_map["y0"], sky_map["cd"], F.radians(sky_map["dec0"])
    u, v = u + _term_sums(sky_map["a"], u, v)["f"], v + _term_sums(sky_map["b"], u, v)["f"]
    xi, eta = F.radians(cd[0] * u + cd[1] * v), F.radians(cd[2] * u + cd[3] * v)
    below = F.cos(d0) - eta * F.sin(d0)
    ra = sky_map["ra0"] + F.degrees(F.atan2(xi, below))
    dec = F.degrees(F.atan2(F.sin(d0) + eta * F.cos(d0), F.hypot(xi, below)))
    return F.pmod(ra, F.lit(360.0)), dec
