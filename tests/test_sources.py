"""FITS files read and written, inventories."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.sources import fits


def test_images_read_back():
    plane = np.arange(12, dtype=float).reshape(3, 4)
    raw = fits.write_image(plane, {"OBJECT": "it", "CRVAL1": 12.5})
    assert len(raw) % fits.BLOCK == 0
    cards, image = fits.read_image(raw)
    assert (image == plane).all() and cards["OBJECT"] == "it" and float(cards["CRVAL1"]) == 12.5
    head = "".join(x.ljust(80) for x in ("SIMPLE  = T", "BITPIX  = 16", "NAXIS   = 2", "NAXIS1  = 2", "NAXIS2  = 1", "BZERO   = 32768 / offset", "END"))
    assert fits.read_image(head.ljust(2880).encode() + np.array([-32768, 1], ">i2").tobytes())[1].tolist() == [[0.0, 32769.0]]
    with pytest.raises(ValueError):
        fits.read_cards(b"no header")
    with pytest.raises(ValueError):
        fits.read_image(head.replace("NAXIS   = 2", "NAXIS   = 3").ljust(2880).encode())


def test_planes_of_files(spark, tmp_path):
    rng = np.random.default_rng(2)
    images = {f"a{i}.fits": rng.integers(0, 9, (5 + i, 4)).astype(float) for i in range(3)}
    images["a0.fits"][2, 1] = np.nan
    for name, image in images.items():
        (tmp_path / name).write_bytes(fits.write_image(image, {"SECTOR": 20}))
    (tmp_path / "note.txt").write_text("x")
    found = fits.files(spark, str(tmp_path))
    rows = fits.planes(found, strip=2).withColumn("frame", F.element_at(F.split("frame", "/"), -1))
    got = {(r.frame, r.y, r.x): r.value for r in rows.collect()}
    assert len(got) == sum(i.size for i in images.values())
    for name, image in images.items():
        for (y, x), v in np.ndenumerate(image):
            assert got[name, y, x] == (None if np.isnan(v) else v)
    assert {r.s for r in fits.headers(found).select(fits.card("SECTOR", "int").alias("s")).collect()} == {20}
    back = {r.frame: fits.read_image(bytes(r.content))[1] for r in fits.encoded(rows, 4, 7).collect()}
    for name, image in images.items():
        n = image.shape[0]
        assert np.array_equal(back[name][:n], image, equal_nan=True) and np.isnan(back[name][n:]).all()
    r = fits.inventory(spark, str(tmp_path)).first()
    assert r.n == 4 and r.bytes == sum(p.stat().st_size for p in tmp_path.iterdir())
