"""Strap gains against a plain version."""

import numpy as np
from pyspark.sql import functions as F

from starloom.operators import straps


def plain_clip(v, low, high):
    for _ in range(5):
        m, s = np.median(v), v.std()
        v = v[(v >= m - low * s) & (v <= m + high * s)]
    return v


def plain_line(v, w):
    out, u = np.empty(len(v)), np.arange(w)
    for i in range(len(v)):
        start = min(max(i - w // 2, 0), len(v) - w)
        out[i] = np.polyval(np.polyfit(u, v[start : start + w], 1), i - start)
    return out


def plain_gains(t, value, ground, mask, floor, gap, least):
    T, ny, nx = value.shape
    gain = np.ones((T, nx))
    for k in range(T):
        for x in range(nx):
            ok = ((mask[:, x] & 4) > 0) & ((mask[:, x] & 1) == 0) & (value[k, :, x] != 0)
            if ok.any():
                gain[k, x] = np.median(plain_clip(value[k, ok, x] / ground[k, ok, x], 3.0, 2.0))
    mean = ground.mean(axis=(1, 2))
    c = plain_clip(mean, 3.0, 3.0)
    quiet = np.flatnonzero(mean < np.median(c) + 5 * c.std())
    for part in np.split(quiet, np.flatnonzero(np.diff(t[quiet]) > gap) + 1):
        if len(part) > least:
            w = len(part) // 4
            for x in range(nx):
                gain[part, x] = plain_line(gain[part, x], w + (w % 2 == 0))
    return np.where(gain < floor, 1.0, gain)


def test_as_a_plain_version(spark):
    rng = np.random.default_rng(3)
    t = np.concatenate((np.arange(30) * 0.02, 5 + np.arange(12) * 0.02))
    ground = rng.uniform(90, 110, (42, 11, 8)) * np.where(np.arange(42) == 7, 50, 1)[:, None, None]
    true = 1 + np.array([0, 0, 0.2, 0.3, 0, 0, 0.05, -0.1])
    value = ground * true * rng.normal(1, 0.02, ground.shape)
    value[:, 4, 2] *= 9
    value[3, :, 3] = 0.0
    mask = np.where(np.isin(np.arange(8), (2, 3, 6, 7)), 4, 0)[None, :] + (rng.random((11, 8)) < 0.2)
    rows = [(f"f{k:02d}", float(t[k]), x, y, float(value[k, y, x]), float(ground[k, y, x]), int(mask[y, x])) for k in range(42) for y in range(11) for x in range(8)]
    df = spark.createDataFrame(rows, "frame string, t double, x long, y long, value double, background double, mask int")
    out = straps.with_strap_gain(df.withColumn("gain", F.lit("old")), least=15).collect()
    expected = plain_gains(t, value, ground, mask, 1.001, 0.5, 15)
    assert len(out) == len(rows)
    for r in out:
        g = expected[int(r.frame[1:]), r.x]
        assert abs(r.gain - g) < 1e-9 and abs(r.corrected - r.background * g) < 1e-6
    assert {r.x for r in out if r.gain > 1} == {2, 3, 6}


def test_no_straps_and_no_rows(spark):
    df = spark.createDataFrame([("a", 0.0, 0, 0, 1.0, 2.0, 0), ("a", 0.0, 1, 0, 1.0, 0.0, 4)], "frame string, t double, x long, y long, value double, background double, mask int")
    assert [(r.gain, r.corrected) for r in straps.with_strap_gain(df).orderBy("x").collect()] == [(1.0, 2.0), (1.0, 0.0)]
    assert straps.with_strap_gain(df.limit(0)).isEmpty()
