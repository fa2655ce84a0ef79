"""Frame manifests: lookups by product id and path, status updates, calibration, templates, the reference frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions import names, scalars, wcs
from starloom.operators import select, stats


def update_last(df: DataFrame, key: Column, results: DataFrame, result_key: str, order: str, columns: dict[str, str], default: dict[str, object], ties: Sequence[str] = ()) -> DataFrame:
    """`df` with columns set from the last result of its key; `columns` names the target of each result column.

    Rows without a result keep what they had, or the default where the column is new.  Of results with the same `order` the least by
    the columns `ties` counts; without them any may.
    """
    known = results.where(F.col(result_key) != "")
    if ties:
        known = known.groupBy(result_key, order).agg(F.min_by(F.struct(*columns), F.struct(*ties)).alias("__first")).select(result_key, order, "__first.*")
    last = select.keep_one(known, [result_key], [order], largest=True)
    last = last.select(F.col(result_key).alias("__key"), F.lit(True).alias("__hit"), *(F.col(c).alias(f"__{c}") for c in columns))
    joined = df.withColumn("__id", key).join(last, F.col("__id") == F.col("__key"), "left")
    for c, target in columns.items():
        old = F.col(target) if target in df.columns else F.lit(default.get(target))
        joined = joined.withColumn(target, F.when(F.col("__hit"), F.coalesce(f"__{c}", F.lit(default.get(target)))).otherwise(old))
    return joined.drop("__id", "__key", "__hit", *(f"__{c}" for c in columns))


def lookup_first(asked: DataFrame, key: Column, table: DataFrame, table_key: Column, order: str, value: str, default) -> DataFrame:
    """`asked` with the value of the first row of its key in `table`, or the default."""
    first = table.select(table_key.alias("__key"), F.struct(order).alias("__order"), F.col(value).alias("__value")).where(F.col("__key") != "")
    first = first.groupBy("__key").agg(F.min_by("__value", "__order").alias("__value"))
    joined = asked.withColumn("__id", key).join(first, F.col("__id") == F.col("__key"), "left")
    return joined.withColumn(value, F.coalesce("__value", F.lit(default))).drop("__id", "__key", "__value")


def path_rows(df: DataFrame, path: str, position: str) -> DataFrame:
    """(key, position) of the last row of each canonical path; blank and null paths have none."""
    keyed = df.select(names.canonical_path(F.col(path)).alias("key"), position).where("key is not null")
    return keyed.groupBy("key").agg(F.max(position).alias(position))


def group_positions(frames: DataFrame, key: Column, group: Column, wanted: int, asked: DataFrame, asked_key: Column, position: str) -> DataFrame:
    """Positions of `asked` (the last of each key) for the rows of `frames` in the wanted group."""
    last = asked.select(asked_key.alias("__key"), position).where(F.col("__key") != "").groupBy("__key").agg(F.max(position).alias(position))
    return frames.where(group == wanted).select("*", key.alias("__id")).join(last, F.col("__id") == F.col("__key")).drop("__id", "__key")


def calibrate(curve: DataFrame, calibration: DataFrame, flux: str = "flux", error: str = "eflux", file: str = "filename", order: str = "product_id") -> DataFrame:
    """A light curve on the scale of a common kernel sum, with magnitudes and Jansky of the measured flux.

    The measured flux is the column flux_uncal (eflux_uncal) if it is there with a value, else `flux` (`error`).  The kernel sum is
    the curve's own column if it has a value, else the calibration's (product_id, kernel_sum, tess_zp), by the product id of the file's
    name, its first row by `order` per id; tess_zp likewise, and from the kernel sum in rows without one.
    Adds flux_uncal, eflux_uncal, kernel_sum, tess_zp, kernel_ref, zp_ref, tmag, etmag, flux_jy and eflux_jy; without
    any usable kernel sum the flux stays as it is.  The columns sci_zp, flux_cal and eflux_cal of older curves go.
    """
    curve = curve.drop("sci_zp", "flux_cal", "eflux_cal")
    has = {c: F.max(F.col(c).isNotNull()) for c in ("flux_uncal", "eflux_uncal", "kernel_sum", "tess_zp") if c in curve.columns}
    held = curve.agg(*(v.alias(c) for c, v in has.items())).first().asDict() if has else {}  # one row
    measured = {"flux_uncal": flux, "eflux_uncal": error}
    curve = curve.withColumns({c: F.col(c if held.get(c) else other).cast("double") if held.get(c) or other in curve.columns else F.lit(None).cast("double") for c, other in measured.items()})
    looked_up = [] if held.get("kernel_sum") else ["kernel_sum", *([] if held.get("tess_zp") else ["tess_zp"])]
    first = select.keep_one(calibration.select("product_id", "kernel_sum", "tess_zp", F.struct(order).alias("__order")), ["product_id"], ["__order"])
    joined = curve.drop(*looked_up).withColumn("__id", names.product_id(F.col(file)) if file in curve.columns else F.lit(None).cast("string"))
    if looked_up:
        joined = joined.join(first.select(F.col("product_id").alias("__product"), *looked_up), F.col("__id") == F.col("__product"), "left").drop("__product")
    joined = joined.drop("__id")
    if "tess_zp" not in joined.columns:
        joined = joined.withColumn("tess_zp", F.lit(None).cast("double"))
    raw, e, k = F.col("flux_uncal"), F.col("eflux_uncal"), F.col("kernel_sum")
    usable = scalars.known(k) & (k > 0) & scalars.known(raw)
    reference = stats.positive_clipped_mean(joined.where(usable).select("kernel_sum"), "kernel_sum", name="kernel_ref")
    out = joined.drop("kernel_ref").join(F.broadcast(reference), how="left")  # one row, or none
    zp = F.coalesce("tess_zp", scalars.zero_point(k))
    scale = F.when(F.col("kernel_ref").isNull(), 1.0).when(scalars.known(k) & (k > 0), F.col("kernel_ref") / k)
    mag = F.when(F.col("kernel_ref").isNotNull() & scalars.known(raw), scalars.magnitude(raw, zp))
    emag = F.when(mag.isNotNull(), scalars.magnitude_error(raw, e))
    out = out.withColumns({"tess_zp": zp, "zp_ref": scalars.zero_point(F.col("kernel_ref")), "tmag": mag, "etmag": emag, flux: raw * scale, error: e * scale})
    return out.withColumns({"flux_jy": scalars.flux_jansky(F.col("tmag")), "eflux_jy": scalars.flux_jansky_error(scalars.flux_jansky(F.col("tmag")), F.col("etmag"))})


def choose_reference(frames: DataFrame, order: str, usable: Column, earth: float = 45.0, moon: float = 25.0, residual: float = 0.05) -> DataFrame:
    """The one frame (with its tier) nearest to the median drift of the usable frames.

    Tiers: small residual and good angles (0), good angles (1), small residual (2), usable (3).  Ties go to the first by `order`.
    Without the columns delta_x_raw and delta_y_raw every residual is small, without earth_deg and moon_deg every angle good.
    """
    dx, dy = F.col("delta_x").cast("double"), F.col("delta_y").cast("double")
    ok = frames.where(F.coalesce(usable, F.lit(False)) & scalars.known(dx) & scalars.known(dy))
    one = [F.lit(1).alias("__one")]
    medians = [stats.quantile(ok.select(*one, c), ["__one"], c, name=f"__{c}").drop("__one") for c in ("delta_x", "delta_y")]
    near = F.pow(dx - F.col("__delta_x"), 2) + F.pow(dy - F.col("__delta_y"), 2)
    has = lambda *columns: {*columns} <= {*frames.columns}
    raw_x, raw_y = (F.col(c).try_cast("double") for c in ("delta_x_raw", "delta_y_raw")) if has("delta_x_raw", "delta_y_raw") else (dx, dy)
    calm = F.hypot(raw_x - dx, raw_y - dy) <= residual
    clear = (F.col("earth_deg").try_cast("double") >= earth) & (F.col("moon_deg").try_cast("double") >= moon) if has("earth_deg", "moon_deg") else F.lit(True)
    calm, clear = F.coalesce(calm, F.lit(False)), F.coalesce(clear, F.lit(False))
    ranked = ok.join(F.broadcast(medians[0])).join(F.broadcast(medians[1])).withColumn("__near", near)  # one row each
    return select.tiered_first(ranked, [calm & clear, clear, calm], ["__near", order]).drop("__near", "__delta_x", "__delta_y")


def reanchor(frames: DataFrame, columns: Sequence[str], reference: Column) -> DataFrame:
    """`columns` less their values in the reference's row, which comes as a broadcast of one row; all rows stay if there is none."""
    row = frames.where(reference).select(*(F.col(c).alias(f"__{c}") for c in columns)).limit(1)
    moved = frames.join(F.broadcast(row), how="left")
    return moved.withColumns({c: F.col(c) - F.coalesce(f"__{c}", F.lit(0.0)) for c in columns}).drop(*(f"__{c}" for c in columns))


def match_templates(groups: DataFrame, files: DataFrame, path: str, chip: tuple[int, int, int] | None = None, threshold: float = 0.01) -> DataFrame:
    """`groups` (group_id, group_dx, group_dy) with the template path of their offsets, or null.

    Offsets agree within a hundredth of the threshold (1e-5 at least).  Of several files one with .fits.gz comes first, then one whose
    name has the offsets to three places, then the least path.
    """
    tolerance = max(1e-5, 0.01 * threshold)
    known = files.select(F.col(path).alias("__path"), names.template_name(F.col(path)).alias("__t")).where("__t is not null")
    if chip:
        known = known.where((F.col("__t.sector") == chip[0]) & (F.col("__t.camera") == chip[1]) & (F.col("__t.ccd") == chip[2]))
    cell = lambda c: F.floor(c / tolerance)
    around = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    near = known.withColumn("__o", F.explode(around)).withColumns({"__cx": cell(F.col("__t.dx")) + F.col("__o.i"), "__cy": cell(F.col("__t.dy")) + F.col("__o.j")})
    asked = groups.select("group_id", "group_dx", "group_dy", cell(F.col("group_dx")).alias("__cx"), cell(F.col("group_dy")).alias("__cy"))
    fits = (F.abs(F.col("__t.dx") - F.col("group_dx")) <= tolerance) & (F.abs(F.col("__t.dy") - F.col("group_dy")) <= tolerance)
    met = asked.join(near, ["__cx", "__cy"]).where(fits)
    exact = F.format_string("_dx%.3f_dy%.3f", F.col("group_dx"), F.col("group_dy"))
    low = F.lower(names.basename(F.col("__path")))
    preference = F.struct(~low.endswith(".fits.gz"), F.instr(low, exact) == 0, F.col("__path"))
    best = met.groupBy("group_id").agg(F.min_by("__path", preference).alias(path))
    return groups.join(best, "group_id", "left")


def required_groups(frames: DataFrame, order: str, usable: Column) -> DataFrame:
    """The first usable row of each group from 0 on with both offsets."""
    ok = frames.where(F.coalesce(usable, F.lit(False)) & (F.col("group_id") >= 0)).dropna(subset=["group_id", "group_dx", "group_dy"])
    return select.keep_one(ok, ["group_id"], [order])


def ordered_paths(asked: DataFrame, recorded: Column, derived: Column, present: DataFrame, path: str) -> DataFrame:
    """Adds `found`: the recorded path if it is present, else the derived one if that is, else null."""
    have = present.select(F.col(path).alias("__have")).distinct()
    out = asked.withColumns({"__recorded": recorded, "__derived": derived})
    for c in ("recorded", "derived"):
        out = out.join(have.withColumnRenamed("__have", f"__have_{c}"), F.col(f"__{c}") == F.col(f"__have_{c}"), "left")
    return out.withColumn("found", F.coalesce("__have_recorded", "__have_derived")).drop("__recorded", "__derived", "__have_recorded", "__have_derived")


def find_target(targets: DataFrame, wanted: str) -> DataFrame:
    """The targets with this label, or else those on this chip (three numbers between , or /); more than one row is ambiguous."""
    labelled = targets.withColumn("label", names.target_label(F.col("sector"), F.col("camera"), F.col("ccd"), F.col("target_name")))
    exact = F.col("label") == wanted.strip()
    numbers = wanted.strip().replace("/", ",").split(",")
    by_chip = F.lit(False)
    if len(numbers) == 3 and all(n.strip().isdigit() for n in numbers):
        by_chip = (F.col("sector") == int(numbers[0])) & (F.col("camera") == int(numbers[1])) & (F.col("ccd") == int(numbers[2]))
    hits = labelled.where(exact | by_chip).withColumn("__exact", exact)
    named = hits.agg(F.max("__exact").alias("__any"))  # one row
    return hits.join(F.broadcast(named)).where(F.col("__exact") | ~F.col("__any")).drop("__exact", "__any")


def forced_positions(frames: DataFrame, mode: str, crop: tuple[float, float] = (0.0, 0.0), science: tuple[float, float] | None = None, usable: Column | None = None, **place: float) -> DataFrame:
    """Adds target_x, target_y, in pixels of the crop whose corner is `crop`.

    sky: the position (ra, dec) through each frame's own map, the struct column `sky_map` (see wcs.SKY_MAP), null where there is none; or, for
    the position `science` itself (within 0.05 seconds of arc), the frames' columns x_pix and y_pix, null in frames that `usable` excludes,
    if any frame has them.  offset: the primary's position (x, y) moved by (dx, dy).  fixed: (x, y) in every frame.
    """
    if mode == "offset":
        at = F.col("x") + place["dx"], F.col("y") + place["dy"]
    elif mode == "fixed":
        at = F.lit(float(place["x"])), F.lit(float(place["y"]))
    elif mode == "sky":
        at = None
        if science is not None and {"x_pix", "y_pix"} <= {*frames.columns} and wcs.separation(*science, place["ra"], place["dec"]) < 0.05 / 3600:
            x, y = (F.col(c).try_cast("double") for c in ("x_pix", "y_pix"))
            ok = scalars.known(x) & scalars.known(y) & (F.lit(True) if usable is None else F.coalesce(usable, F.lit(False)))
            if not frames.where(ok).isEmpty():
                at = F.when(ok, x - crop[0]), F.when(ok, y - crop[1])
        if at is None:
            x, y = wcs.sky_to_pixel(F.lit(float(place["ra"])), F.lit(float(place["dec"])), F.col("sky_map"))
            at = x - crop[0], y - crop[1]
    else:
        raise ValueError(f"no position mode {mode}")
    return frames.withColumns({"target_x": at[0], "target_y": at[1]})


#: The modes of a forced target's place, with the columns that give it.
POSITION_MODES = {"sky": ("ra", "dec"), "offset": ("dx", "dy"), "fixed": ("x", "y")}


def checked_targets(entries: DataFrame) -> DataFrame:
    """(name, position_mode, ra, dec, dx, dy, x, y, problem) of target entries (name and any of the places, as text or numbers).

    name becomes safe for file names; a place is given where neither of its two columns is null; problem says what is wrong with an entry:
    no usable name, no place or several, one that isn't a number, or a name that other entries have too.  It's null if all is well.
    """
    has = lambda c: F.col(c).isNotNull() if c in entries.columns else F.lit(False)
    given = {mode: has(a) & has(b) for mode, (a, b) in POSITION_MODES.items()}
    n_modes = sum((g.cast("int") for g in given.values()), F.lit(0))
    mode = F.coalesce(*(F.when(g, F.lit(m)) for m, g in given.items()))
    name = names.light_curve_name(F.col("name"))
    number = lambda c: F.col(c).try_cast("double") if c in entries.columns else F.lit(None).cast("double")
    places = {c: F.when(F.col("position_mode") == m, F.col(f"__{c}")).alias(c) for m, pair in POSITION_MODES.items() for c in pair}
    rows = entries.select(name.alias("name"), mode.alias("position_mode"), n_modes.alias("__modes"), *(number(c).alias(f"__{c}") for c in places))
    same = F.count(F.lit(1)).over(Window.partitionBy("name"))
    numeric = F.lit(False)
    for m, (a, b) in POSITION_MODES.items():
        numeric = numeric | ((F.col("position_mode") == m) & F.col(f"__{a}").isNotNull() & F.col(f"__{b}").isNotNull())
    problem = (
        F.when(F.col("name").isNull(), "no usable name").when(F.col("__modes") != 1, "one of (ra, dec), (dx, dy), (x, y) must be given")
        .when(~numeric, "places must be numbers").when(same > 1, "a name must be unique")
    )
    return rows.select("name", "position_mode", *places.values(), problem.alias("problem"))


def normalized_targets(entries: DataFrame) -> DataFrame:
    """The checked targets without `problem`; the job fails with the first one found."""
    checked = checked_targets(entries)
    name = F.when(F.col("problem").isNull(), F.col("name")).otherwise(F.raise_error(F.concat(F.lit("forced target "), F.coalesce("name", F.lit("?")), F.lit(": "), F.col("problem"))).cast("string"))
    return checked.withColumn("name", name).drop("problem")


def target_places(frames: DataFrame, targets: DataFrame, crop: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """(frame, source, target_x, target_y) of all normalised targets in all frames (frame, x, y of the primary, sky_map where sky targets need it).

    Targets are what somebody listed, tens of rows: they come to the frames as one array.
    """
    listed = targets.agg(F.collect_list(F.struct(*targets.columns)).alias("__targets"))  # one row
    t = lambda c: F.col(f"__t.{c}")
    each = frames.join(F.broadcast(listed)).withColumn("__t", F.explode("__targets"))
    sky = wcs.sky_to_pixel(t("ra"), t("dec"), F.col("sky_map")) if "sky_map" in frames.columns else (F.lit(None), F.lit(None))
    at = lambda i, corner: F.when(t("position_mode") == "sky", sky[i] - corner).when(t("position_mode") == "offset", F.col("xy"[i]) + t(f"d{'xy'[i]}")).otherwise(t("xy"[i]))
    return each.select("frame", t("name").alias("source"), at(0, crop[0]).cast("double").alias("target_x"), at(1, crop[1]).cast("double").alias("target_y"))
