"""The masked mesh background against a plain version."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.operators import background


def plain_background(value, mask, box, exclude, kappa, rounds, neighbours, size=3):
    ny, nx = value.shape
    by, bx = -(-ny // box), -(-nx // box)
    levels = np.full((by, bx), np.nan)
    for i in range(by):
        for j in range(bx):
            part = value[i * box : i * box + box, j * box : j * box + box]
            v = part[(mask[i * box : i * box + box, j * box : j * box + box] == 0) & np.isfinite(part)]
            if box * box - len(v) > exclude * box * box or not len(v):
                continue
            for _ in range(rounds):
                v = v[np.abs(v - np.median(v)) <= kappa * v.std()]
            levels[i, j] = np.median(v)
    known = [(i, j) for i in range(by) for j in range(bx) if np.isfinite(levels[i, j])]
    if not known:
        good = value[(mask == 0) & np.isfinite(value)]
        return np.full(value.shape, np.median(good) if good.size else 0.0)
    full = levels.copy()
    for i in range(by):
        for j in range(bx):
            if not np.isfinite(levels[i, j]):
                near = sorted(known, key=lambda p: (np.hypot(p[0] - i, p[1] - j), p))[:neighbours]
                w = [1 / np.hypot(p[0] - i, p[1] - j) for p in near]
                full[i, j] = sum(a * levels[p] for a, p in zip(w, near)) / sum(w)
    h = size // 2
    smooth = np.array([[np.median(full[max(0, i - h) : i + h + 1, max(0, j - h) : j + h + 1]) for j in range(bx)] for i in range(by)])
    out = np.zeros(value.shape)
    for y in range(ny):
        for x in range(nx):
            a, b = np.clip((y + 0.5) / box - 0.5, 0, by - 1), np.clip((x + 0.5) / box - 0.5, 0, bx - 1)
            i, j = int(a), int(b)
            i1, j1 = min(i + 1, by - 1), min(j + 1, bx - 1)
            u, v = a - i, b - j
            out[y, x] = (1 - u) * ((1 - v) * smooth[i, j] + v * smooth[i, j1]) + u * ((1 - v) * smooth[i1, j] + v * smooth[i1, j1])
    return out


def table_of(spark, values, masks):
    rows = [(f, x, y, None if np.isnan(v[y, x]) else float(v[y, x]), int(masks[f][y, x])) for f, v in values.items() for y in range(v.shape[0]) for x in range(v.shape[1])]
    return spark.createDataFrame(rows, "frame string, x long, y long, value double, mask int")


@pytest.mark.parametrize("box,options", [(6, {}), (5, {"exclude": 0.2, "kappa": 2.0, "rounds": 3, "neighbours": 3})])
def test_as_a_plain_version(spark, box, options):
    rng = np.random.default_rng(1)
    values, masks = {}, {}
    for f in "abc":
        v = rng.normal(100, 4, (32, 45)) + np.arange(45)[None, :] + (rng.random((32, 45)) < 0.05) * 500
        v[rng.random(v.shape) < 0.05] = np.nan
        m = (rng.random(v.shape) < 0.2) * 4
        m[8:20, 10:30] = 1  # whole boxes
        values[f], masks[f] = v, m
    masks["c"][:] = 1
    masks["c"][0, :9] = 0  # every box is excluded
    out = background.with_background(table_of(spark, values, masks).withColumn("background", F.lit("old")), 45, 32, box, **options)
    assert out.columns == ["frame", "x", "y", "value", "mask", "background"]
    full = {"exclude": 0.5, "kappa": 3.0, "rounds": 10, "neighbours": 10} | options
    found = {f: np.full((32, 45), np.nan) for f in "abc"}
    for r in out.collect():
        found[r.frame][r.y, r.x] = r.background
    for f in "abc":
        assert np.allclose(found[f], plain_background(values[f], masks[f], box, **full)), f


def test_frames_without_a_pixel(spark):
    v = np.full((8, 8), np.nan)
    out = background.with_background(table_of(spark, {"a": v}, {"a": np.zeros((8, 8))}), 8, 8)
    assert [r.background for r in out.select("background").distinct().collect()] == [0.0]
    assert background.with_background(table_of(spark, {"a": v}, {"a": np.zeros((8, 8))}).limit(0), 8, 8).isEmpty()
    assert background.box_for(4, 100, 100) == 4 and background.box_for(64, 100, 60) == 30 and background.box_for(1, 5, 5) == 4
