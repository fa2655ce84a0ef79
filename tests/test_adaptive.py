"""Adaptive median smoothing of a whole cube against a plain version."""

import numpy as np
import pytest

from starloom.operators import adaptive
from starloom.operators.adaptive import AdaptiveModel, odd

NAN = float("nan")


def reflected(i, n):
    i %= 2 * n
    return i if i < n else 2 * n - 1 - i


def running(x, w, f):
    return np.array([f(sorted(x[reflected(i + k, len(x))] for k in range(-(w // 2), w // 2 + 1))) for i in range(len(x))])


def fit(w, n):
    return odd(min(w, n if n % 2 else n - 1))


def plain(cube, t, m, angles=None):
    """One pixel at a time, cube (times, ny, nx)."""
    T, ny, nx = cube.shape
    steps = np.diff(t)
    cuts = [0, *(np.flatnonzero(steps > m.gap * np.median(steps)) + 1), T]
    segments = list(zip(cuts[:-1], cuts[1:]))
    filled = cube.copy()
    for s, e in segments:
        for p in np.ndindex(ny, nx):
            v = filled[(slice(s, e), *p)]
            ok = np.isfinite(v)
            filled[(slice(s, e), *p)] = np.interp(t[s:e], t[s:e][ok], v[ok]) if ok.any() else 0.0
    middle = lambda v: v[len(v) // 2]
    at = lambda v, pc: v[min(len(v) - 1, int(len(v) * pc / 100))]
    b = m.block
    red = filled[:, : ny // b * b, : nx // b * b].reshape(T, ny // b, b, nx // b, b).mean(axis=(2, 4))

    def each(source, f):
        out = np.zeros_like(source)
        for s, e in segments:
            for p in np.ndindex(source.shape[1:]):
                out[(slice(s, e), *p)] = f(source[(slice(s, e), *p)], s, e)
        return out

    def scale(x, floor):
        w = lambda n: fit(odd(m.norm_window), n)
        lo, hi = (each(x, lambda v, s, e, pc=pc: running(v, w(e - s), lambda r: at(r, pc))) for pc in (m.low, m.high))
        span = np.where(hi > lo, hi - lo, 1.0) if floor is None else np.maximum(hi - lo, floor)
        return np.clip((x - lo) / span, 0, 1)

    if m.metric == "deviation":
        mean = red.mean(axis=(1, 2))
        c = mean
        for _ in range(5):
            if c.std() == 0:
                break
            c = c[np.abs(c - np.median(c)) < m.brightness * c.std()]
        bright = mean > c.mean() + m.brightness * c.std()
        calm = np.zeros(T, bool)
        if angles is not None:
            free = angles.min(axis=1) > m.scatter_angle
            calm = free & ~bright & (~free).any()
        norms = []
        for k, cw in enumerate(m.coarse):
            dev = each(red, lambda v, s, e: running(np.abs(v - running(v, fit(cw, e - s), middle)), fit(odd(m.smooth_gradient), e - s), middle))
            n = scale(dev, max(np.percentile(dev, 75), 1e-10))
            norms.append((n * bright[:, None, None] if k == 0 else n) * ~calm[:, None, None])
        var = norm = np.max(norms, axis=0)
    else:
        gw = odd(m.smooth_gradient)
        grad = np.zeros_like(filled)
        for s, e in segments:
            if e - s > 1:
                grad[s:e] = np.gradient(filled[s:e], t[s:e], axis=0)
            grad[s] = 0 if s > 0 else grad[s]
            grad[e - 1] = 0 if e < T else grad[e - 1]
        grad = each(grad, lambda v, s, e: np.abs(running(v, gw, middle)) if e - s >= gw else np.abs(v))
        std = each(filled, lambda v, s, e: running(v, fit(odd(m.deviation_window), e - s), np.std))
        one = lambda x: np.clip((x - np.percentile(x, 1)) / (np.percentile(x, 99) - np.percentile(x, 1) + 1e-30), 0, 1)
        var = {"gradient": grad, "local_std": std, "combined": (1 - m.weight) * one(grad) + m.weight * one(std)}[m.metric]
        norm = scale(var, None)
    w = np.round(m.most - norm * (m.most - m.least)).astype(int)
    w = np.clip(w + 1 - w % 2, odd(m.least), odd(m.most))
    up = lambda a: np.array([[a[:, min(y // b, ny // b - 1), min(x // b, nx // b - 1)] for x in range(nx)] for y in range(ny)]).transpose(2, 0, 1)
    w, var = up(w), up(var)
    levels = np.unique([odd(round(v)) for v in np.linspace(m.least, m.most, m.levels)])
    level = levels[np.abs(w[..., None] - levels).argmin(axis=-1)]
    out = np.zeros_like(filled)
    for size in levels:
        out = np.where(level == size, each(filled, lambda v, s, e: running(v, size, middle)), out)
    if m.kappa is not None:
        r = np.median(np.abs(out - filled), axis=(1, 2))
        bad = r > np.median(r) + m.kappa * 1.4826 * np.median(np.abs(r - np.median(r)))
        out[bad] = filled[bad]
    return np.where(np.isfinite(cube), out, np.nan), w, var


@pytest.fixture(scope="module")
def cube():
    rng = np.random.default_rng(11)
    t = np.concatenate((np.arange(30) * 0.1, 20 + np.arange(19) * 0.1, [40.0]))
    wave = 50 + 10 * np.sin(t)[:, None, None] + rng.normal(0, 1, (50, 7, 9)) + (np.abs(np.arange(50) - 12) < 3)[:, None, None] * 60
    wave[33] += rng.normal(0, 40, (7, 9))
    wave[rng.random(wave.shape) < 0.03] = NAN
    wave[:30, 2, 3] = NAN
    return t, wave


@pytest.mark.parametrize("options", [
    {"coarse": (5, 9), "norm_window": 15, "most": 11}, {"coarse": (5, 9), "norm_window": 15, "most": 11, "block": 2, "kappa": None}, {"metric": "gradient", "smooth_gradient": 5, "norm_window": 9, "most": 9},
    {"metric": "local_std", "deviation_window": 5, "most": 9, "least": 5, "levels": 3}, {"metric": "combined", "weight": 0.3, "most": 9},
])
def test_as_a_plain_version(spark, cube, options):
    t, values = cube
    m = AdaptiveModel(**options)
    angles = np.column_stack((np.where(np.arange(50) < 5, 20.0, 80.0), np.full(50, 90.0))) if "coarse" in options else None
    rows = [(f"f{k:02d}", float(t[k]), x, y, None if np.isnan(v) else float(v)) for k in range(50) for y in range(7) for x in range(9) for v in [values[k, y, x]]]
    df = spark.createDataFrame(rows, "frame string, t double, x long, y long, value double")
    table = None if angles is None else spark.createDataFrame([(f"f{k:02d}", *map(float, a)) for k, a in enumerate(angles)], "frame string, earth double, moon double")
    out = adaptive.adaptive_smooth(df, 9, 7, m, tile=4, angles=table).collect()
    expected, windows, variability = plain(values, t, m, angles)
    assert len(out) == len(rows)
    for r in out:
        k = int(r.frame[1:])
        assert (r.smooth is None) == bool(np.isnan(expected[k, r.y, r.x])) == (r.value is None)
        assert r.window == windows[k, r.y, r.x] and abs(r.variability - variability[k, r.y, r.x]) < 1e-9
        assert r.smooth is None or abs(r.smooth - expected[k, r.y, r.x]) < 1e-9
    assert len({r.window for r in out}) > 1


def test_empty_cubes_and_unknown_metrics(spark):
    df = spark.createDataFrame([], "frame string, t double, x long, y long, value double")
    assert adaptive.adaptive_smooth(df, 9, 7).isEmpty()
    for options in ({"metric": "other"}, {"metric": "gradient", "block": 2}):
        with pytest.raises(ValueError):
            AdaptiveModel(**options)
    single = spark.createDataFrame([("a", 0.0, 0, 0, 5.0)], "frame string, t double, x long, y long, value double")
    assert [tuple(r)[:4] for r in adaptive.adaptive_smooth(single, 1, 1).collect()] == [("a", 0, 0, 5.0)]
