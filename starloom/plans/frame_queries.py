"""Queries of names, geometry, calibration and manifests, with their SQL.  Names and positions come from keys, as the tables have none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import names, scalars, wcs
from starloom.operators import manifest, pixels, sequence, stats
from starloom.plans.queries import T, events, query, r6

#: Expressions that mean the same in Spark and in the SQL.
FRAME = """concat('/ffi/', CASE WHEN o_orderkey % 7 = 0 THEN 'other' WHEN o_orderkey % 7 = 1 THEN 'TESS' ELSE 'tess' END, o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '_hp_d' ELSE '-s0020' END,
CASE o_orderkey % 5 WHEN 0 THEN '.fits.gz' WHEN 1 THEN '.FITS' WHEN 2 THEN '.txt' WHEN 3 THEN '' ELSE '.fits' END)"""
TEMPLATE_FILE = """concat('/t/sky_template_s', s_suppkey % 90 + 1, '_', s_suppkey % 4 + 1, '_3', CASE WHEN s_suppkey % 2 = 0 THEN concat('_x', s_suppkey % 10, '-1068_y0-2048') ELSE '' END,
'_dx', CASE WHEN s_suppkey % 3 = 0 THEN '-0.0' ELSE '0.0' END, s_suppkey % 5, CASE WHEN s_suppkey % 11 = 0 THEN '' ELSE '0' END, '_dy0.0', s_suppkey % 4, '0', CASE WHEN s_suppkey % 13 = 0 THEN '.png' WHEN s_suppkey % 2 = 0 THEN '.fits' ELSE '.fits.gz' END)"""
TEMPLATE_SQL = r"^[a-z]+_template_s(\d+)_(\d+)_(\d+)(?:_x(\d+)-(\d+)_y(\d+)-(\d+))?(?:_os\d+)?_dx([+-]?\d*\.?\d+)_dy([+-]?\d*\.?\d+)\.fits(?:\.gz)?$"
STEM = r"CASE WHEN regexp_matches(base, '(?i)\.fits(\.gz)?$') THEN regexp_replace(base, '(?i)\.fits(\.gz)?$', '') ELSE regexp_replace(base, '^(.*[^.].*)\.[^.]*$', '\1') END"


@query(rf"""WITH p AS (SELECT o_orderkey, {FRAME} AS path FROM orders), b AS (SELECT *, regexp_replace(path, '^.*/', '') AS base FROM p), s AS (SELECT *, {STEM} AS stem FROM b),
i AS (SELECT *, nullif(regexp_extract(stem, '(?i)^(tess\d+)', 1), '') AS product_id, nullif(regexp_extract(stem, '(?i)^(tess\d+)_(.+)$', 2), '') AS label FROM s)
SELECT o_orderkey, stem, regexp_matches(base, '(?i)\.fits(\.gz)?$') AS is_fits, product_id, label, coalesce(product_id, '') AS coerced, product_id || '_hp_d' AS workspace_stem,
regexp_replace(path, '\.fits\.gz$', '.fits') AS path_key, coalesce(label, 'none') AS label_text FROM i""")
def frame_names(spark, d):
    p = T(spark, d, "orders").select("o_orderkey", F.expr(FRAME).alias("path"))
    path, label = F.col("path"), names.parse_workspace_stem(F.col("path"))["label"]
    return p.select(
        "o_orderkey", names.strip_fits_suffix(path).alias("stem"), names.is_fits_name(path).alias("is_fits"), names.product_id(path).alias("product_id"), label.alias("label"),
        names.coerced_product_id(path).alias("coerced"), names.workspace_stem(names.product_id(path), F.lit("hp d")).alias("workspace_stem"),
        names.canonical_path(path).alias("path_key"), names.text_or(label, "none").alias("label_text"),
    )


@query("WITH f AS (SELECT s_suppkey, lower(regexp_replace(" + TEMPLATE_FILE + ", '^.*/', '')) AS base FROM supplier), m AS (SELECT * FROM f WHERE regexp_matches(base, '" + TEMPLATE_SQL + "')) SELECT s_suppkey, "
    + ", ".join(f"try_cast(regexp_extract(base, '{TEMPLATE_SQL}', {i + 1}) AS {kind}) AS {name}" for i, (name, kind) in enumerate(names.TEMPLATE_PARTS)) + " FROM m")
def template_names(spark, d):
    f = T(spark, d, "supplier").select("s_suppkey", names.template_name(F.expr(TEMPLATE_FILE)).alias("t"))
    return f.where("t is not null").select("s_suppkey", "t.*")


COVERAGE = "concat('S', c_custkey % 70, 'C', c_custkey % 4 + 1, 'D2; s', c_custkey % 9, 'c1d4 ,; ')"


@query(rf"""WITH t AS (SELECT c_custkey, unnest(regexp_extract_all({COVERAGE}, '(?i)S\d+C\d+D\d+')) AS token FROM customer)
SELECT c_custkey, CAST(regexp_extract(token, '(?i)S(\d+)C(\d+)D(\d+)', 1) AS INT) AS sector, CAST(regexp_extract(token, '(?i)S(\d+)C(\d+)D(\d+)', 2) AS INT) AS camera, CAST(regexp_extract(token, '(?i)S(\d+)C(\d+)D(\d+)', 3) AS INT) AS ccd FROM t""")
def coverage_triples(spark, d):
    return T(spark, d, "customer").select("c_custkey", F.inline(names.coverage(F.expr(COVERAGE))))


CHIP = "concat(c_custkey % 70, CASE WHEN c_custkey % 2 = 0 THEN ', ' ELSE '/' END, c_custkey % 4, CASE WHEN c_custkey % 9 = 0 THEN '' ELSE '/3' END)"
CURVE = "concat(' ', c_name, CASE WHEN c_custkey % 5 = 0 THEN '/x' WHEN c_custkey % 5 = 1 THEN ' #__(b) ' ELSE '' END)"


@query(rf"""WITH c AS (SELECT c_custkey, c_name, regexp_split_to_array(trim({CHIP}), '[,/]') AS parts, trim({CURVE}) AS curve FROM customer),
n AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(curve, '[^0-9A-Za-z._+-]+', '_', 'g'), '_+', '_', 'g'), '^_+|_+$', '', 'g') AS clean FROM c)
SELECT c_custkey, CASE WHEN len(parts) = 3 THEN CAST(trim(parts[1]) AS INT) END AS sector, CASE WHEN len(parts) = 3 THEN CAST(trim(parts[3]) AS INT) END AS ccd,
CASE WHEN NOT regexp_matches(curve, '[/\\]') AND clean <> '' THEN clean END AS curve, printf('s%04d_c1_k2_%s', c_custkey, regexp_replace(trim(c_name), '[^\w.-]+', '_', 'g')) AS label FROM n""")
def safe_names(spark, d):
    chip = names.chip(F.expr(CHIP))
    return T(spark, d, "customer").select(
        "c_custkey", chip["sector"].alias("sector"), chip["ccd"].alias("ccd"), names.light_curve_name(F.expr(CURVE)).alias("curve"),
        names.target_label(F.col("c_custkey"), F.lit(1), F.lit(2), F.col("c_name")).alias("label"),
    )


CELL = "concat('skycell.', 1000 + s_suppkey % 2000, '.0', s_suppkey % 10, s_suppkey % 7)"
HEADER = "concat('BOFFSET = ', s_suppkey % 30, '.5 / x  BSOFTEN =  2.5', CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE ' EXPTIME= 30' END)"


@query(rf"""WITH c AS (SELECT s_suppkey, {CELL} AS cell, {HEADER} AS header FROM supplier)
SELECT s_suppkey, CAST(split_part(cell, '.', 2) AS INT) AS projection, CAST(substr(split_part(cell, '.', 3), 2, 1) AS INT) AS y, CAST(substr(split_part(cell, '.', 3), 3, 1) AS INT) AS x,
regexp_extract('/reg/a_' || cell || '.fits', '(skycell\.\d+\.\d+)', 1) AS cell, CASE WHEN s_suppkey % 4 = 0 THEN 1000::DOUBLE ELSE s_suppkey % 30 + 0.5::DOUBLE END AS boffset, CASE WHEN s_suppkey % 4 = 0 THEN 1::DOUBLE ELSE 30::DOUBLE END AS exptime FROM c""")
def cell_names(spark, d):
    cell, header = F.expr(CELL), names.flux_header(F.expr(HEADER))
    found = names.cell_id(cell)
    return T(spark, d, "supplier").select(
        "s_suppkey", names.projection_of(cell).cast("int").alias("projection"), found["y"].alias("y"), found["x"].alias("x"),
        names.cell_name(F.concat(F.lit("/reg/a_"), cell, F.lit(".fits"))).alias("cell"), header["boffset"].alias("boffset"), header["exptime"].alias("exptime"),
    )


@query("""WITH s AS (SELECT c_custkey, 10 + (c_custkey % 90) / 10.0::DOUBLE AS g, CASE WHEN c_custkey % 6 <> 0 THEN (c_custkey % 31) / 10.0::DOUBLE END AS colour, c_acctbal / 1000 AS kernel FROM customer),
m AS (SELECT *, CASE WHEN colour IS NULL THEN g - 0.430 ELSE g + 0.0324473 - 0.633923 * colour + 0.0891337 * colour ** 2 - 0.00522555 * colour ** 3 END AS mag FROM s)
SELECT c_custkey, round(mag, 6) AS mag, round(pow(10, -0.4 * (mag - 20.44)), 4) AS flux, round(CASE WHEN kernel > 0 THEN 25 + 2.5 * log10(kernel) END, 6) AS zero_point, round(2416 * pow(10, -0.4 * mag) * (ln(10) / 2.5) * 0.01, 8) AS jansky_error FROM m""")
def band_magnitudes(spark, d):
    k = F.col("c_custkey")
    bp = F.when(k % 6 != 0, 12 + k % 31 / 10)
    mag = scalars.band_magnitude(10 + k % 90 / 10, bp, F.lit(12.0))
    return T(spark, d, "customer").select(
        "c_custkey", r6(mag).alias("mag"), F.round(scalars.band_flux(mag), 4).alias("flux"), r6(scalars.zero_point(F.col("c_acctbal") / 1000)).alias("zero_point"),
        F.round(scalars.flux_jansky_error(scalars.flux_jansky(mag), F.lit(0.01)), 8).alias("jansky_error"),
    )


@query("""SELECT l_orderkey, l_linenumber, round((5 + 2 * l_tax * sinh(l_quantity / 10 / (2.5 / ln(10)))) / 30, 6) AS rate, round(sqrt(5 + 2 * l_tax * sinh(l_quantity / 10 / (2.5 / ln(10)))) / 30, 6) AS deviation FROM lineitem""".replace("sinh(l_quantity / 10 / (2.5 / ln(10)))", "((exp(l_quantity / 10 / (2.5 / ln(10))) - exp(-l_quantity / 10 / (2.5 / ln(10)))) / 2)"))
def stretched_fluxes(spark, d):
    args = F.col("l_quantity") / 10, F.lit(5.0), F.col("l_tax"), F.lit(30.0)
    return T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", r6(scalars.stretched_flux(*args)).alias("rate"), r6(scalars.stretched_flux(*args, deviation=True)).alias("deviation"))


CLIP = """, b{i} AS (SELECT quantile_cont(k, 0.5) - 3 * stddev_pop(k) AS lo, quantile_cont(k, 0.5) + 3 * stddev_pop(k) AS hi FROM u, b{j} WHERE k BETWEEN lo AND hi)"""


@query(r"""WITH c AS (SELECT 'tess' || c_custkey AS product_id, CASE WHEN c_nationkey % 7 = 1 THEN -1.0::DOUBLE WHEN c_custkey % 97 = 3 THEN 0.5::DOUBLE ELSE 0.02::DOUBLE + (c_nationkey % 5) * 0.002::DOUBLE END AS k FROM customer WHERE c_nationkey % 7 <> 0),
e AS (SELECT event_id, value AS raw, event_id % 10 + 0.5::DOUBLE AS err, k FROM events LEFT JOIN c ON product_id = 'tess' || user_id), u AS (SELECT k FROM e WHERE k > 0 AND raw IS NOT NULL), b0 AS (SELECT -1e300::DOUBLE AS lo, 1e300::DOUBLE AS hi)"""
    + "".join(CLIP.format(i=i, j=i - 1) for i in range(1, 6))
    + """, r AS (SELECT avg(k) AS ref FROM u, b5 WHERE k BETWEEN lo AND hi), m AS (SELECT *, CASE WHEN k > 0 THEN 25 + 2.5 * log10(k) END AS zp FROM e, r)
SELECT event_id, raw AS flux_uncal, round(CASE WHEN k > 0 THEN raw * ref / k END, 6) AS flux, round(CASE WHEN k > 0 THEN err * ref / k END, 6) AS eflux, round(zp, 6) AS tess_zp, round(25 + 2.5 * log10(ref), 6) AS zp_ref,
round(CASE WHEN raw > 0 THEN zp - 2.5 * log10(raw) END, 6) AS tmag, round(CASE WHEN raw > 0 AND zp IS NOT NULL THEN 2.5 / ln(10) * err / raw END, 6) AS etmag,
round(CASE WHEN raw > 0 THEN 2416 * pow(10, -0.4 * (zp - 2.5 * log10(raw))) END, 6) AS flux_jy FROM m""")  # fmt: skip
def kernel_calibration(spark, d):
    n, k = F.col("c_nationkey"), F.col("c_custkey")
    kernel = F.when(n % 7 == 1, -1.0).when(k % 97 == 3, 0.5).otherwise(0.02 + n % 5 * F.lit(0.002))
    c = T(spark, d, "customer").where("c_nationkey % 7 <> 0").select(F.concat(F.lit("tess"), "c_custkey").alias("product_id"), kernel.alias("kernel_sum"), F.lit(None).cast("double").alias("tess_zp"))
    e = T(spark, d, "events").select("event_id", F.col("value").alias("flux"), (F.col("event_id") % 10 + 0.5).alias("eflux"), F.concat(F.lit("/ffi/tess"), "user_id", F.lit("-s1.fits")).alias("filename"))
    out = manifest.calibrate(e, c)
    return out.select("event_id", "flux_uncal", *(r6(F.col(x)).alias(x) for x in ("flux", "eflux", "tess_zp", "zp_ref", "tmag", "etmag", "flux_jy")))


@query("""WITH r AS (SELECT l_orderkey, arg_max(struct_pack(ok := l_returnflag = 'R', msg := l_linestatus), (l_shipdate, l_linenumber)) AS r FROM lineitem WHERE l_quantity > 10 GROUP BY l_orderkey)
SELECT o_orderkey, coalesce(r.ok, false) AS hp_ok, coalesce(r.msg, '') AS hp_error FROM orders LEFT JOIN r ON l_orderkey = o_orderkey""")
def status_update(spark, d):
    o = T(spark, d, "orders").select("o_orderkey")
    place = [F.col(f"_metadata.{c}").alias(c) for c in ("file_path", "row_index")]  # equal results: the first one read, as in SQL
    seq = F.struct(*(c for n in ("l_shipdate", "l_linenumber") for c in (F.col(n).isNull().alias(f"no_{n}"), F.col(n))))  # unknown ones count as last, as in SQL
    results = T(spark, d, "lineitem").where("l_quantity > 10").select(F.col("l_orderkey").cast("string").alias("id"), seq.alias("seq"), (F.col("l_returnflag") == "R").alias("ok"), F.col("l_linestatus").alias("msg"), *place)
    return manifest.update_last(o, F.col("o_orderkey").cast("string"), results, "id", "seq", {"ok": "hp_ok", "msg": "hp_error"}, {"hp_ok": False, "hp_error": ""}, ["file_path", "row_index"])


@query("""WITH f AS (SELECT o_custkey, arg_min(o_orderkey % 6, o_orderkey) AS group_id FROM orders GROUP BY o_custkey) SELECT c_custkey, coalesce(group_id, -1) AS group_id FROM customer LEFT JOIN f ON o_custkey = c_custkey""")
def group_lookup(spark, d):
    frames = T(spark, d, "orders").select("o_orderkey", F.concat(F.lit("/x/tess"), "o_custkey", F.lit(".fits")).alias("path"), (F.col("o_orderkey") % 6).alias("group_id"))
    asked = T(spark, d, "customer").select("c_custkey", F.concat(F.lit("tess"), "c_custkey", F.lit("_hp")).alias("stem"))
    return manifest.lookup_first(asked, names.coerced_product_id(F.col("stem")), frames, names.coerced_product_id(F.col("path")), "o_orderkey", "group_id", -1).select("c_custkey", "group_id")


@query("""WITH p AS (SELECT concat('/a/', o_custkey, '.fits') AS key, o_orderkey FROM orders WHERE o_orderstatus <> 'P') SELECT key, max(o_orderkey) AS o_orderkey FROM p GROUP BY key""")
def path_index(spark, d):
    path = F.when(F.col("o_orderstatus") == "P", " ").otherwise(F.concat(F.lit("/a/"), "o_custkey", F.when(F.col("o_orderkey") % 2 == 0, ".fits.gz").otherwise(".fits")))
    return manifest.path_rows(T(spark, d, "orders").select("o_orderkey", path.alias("path")), "path", "o_orderkey")


@query("""WITH l AS (SELECT c_custkey, max(o_orderkey) AS pos FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_nationkey = 3 GROUP BY c_custkey) SELECT c_custkey, pos FROM l""")
def group_members(spark, d):
    c = T(spark, d, "customer").select("c_custkey", "c_nationkey")
    asked = T(spark, d, "orders").select(F.concat(F.lit("tess"), "o_custkey").alias("id"), F.col("o_orderkey").alias("pos"))
    key = F.concat(F.lit("tess"), "c_custkey")
    return manifest.group_positions(c, key, F.col("c_nationkey"), 3, asked, names.coerced_product_id(F.col("id")), "pos").select("c_custkey", "pos")


SHIFTS = "o_orderkey, (o_orderkey * 7919 % 101) / 1000.0::DOUBLE - 0.05 AS delta_x, CASE WHEN o_orderkey % 17 <> 0 THEN (o_orderkey * 104729 % 103) / 1000.0::DOUBLE END AS delta_y"


def shifts(spark, d) -> DataFrame:
    k = F.col("o_orderkey")
    return T(spark, d, "orders").select("o_orderkey", (k * 7919 % 101 / 1000 - 0.05).alias("delta_x"), F.when(k % 17 != 0, k * 104729 % 103 / 1000).alias("delta_y"), "o_orderstatus", "o_orderdate")


@query(f"""WITH s AS (SELECT {SHIFTS}, o_orderstatus FROM orders), g AS (SELECT *, CASE WHEN o_orderstatus <> 'P' AND delta_y IS NOT NULL THEN round(round_even(delta_x / 0.02, 0) * 0.02, 6) END AS gx, CASE WHEN o_orderstatus <> 'P' AND delta_y IS NOT NULL THEN round(round_even(delta_y / 0.02, 0) * 0.02, 6) END AS gy FROM s),
f AS (SELECT gx, gy, row_number() OVER (ORDER BY min(o_orderkey)) - 1 AS n FROM g WHERE gx IS NOT NULL GROUP BY gx, gy) SELECT o_orderkey, coalesce(n, -1)::INT AS group_id, round(gx + 0.0, 6) AS group_dx, round(gy + 0.0, 6) AS group_dy FROM g LEFT JOIN f USING (gx, gy)""")
def template_groups(spark, d):
    out = stats.first_seen_groups(shifts(spark, d), ["o_orderkey"], {"delta_x": 0.02, "delta_y": 0.02}, F.col("o_orderstatus") != "P")
    return out.select("o_orderkey", "group_id", r6(F.col("group_delta_x") + 0.0).alias("group_dx"), r6(F.col("group_delta_y") + 0.0).alias("group_dy"))


@query(f"""WITH s AS (SELECT {SHIFTS}, (o_orderkey * 31 % 90)::DOUBLE AS earth_deg, (o_orderkey * 17 % 60)::DOUBLE AS moon_deg, (o_orderkey % 13) / 100.0::DOUBLE AS away FROM orders WHERE o_orderstatus <> 'P'), u AS (SELECT * FROM s WHERE delta_y IS NOT NULL),
m AS (SELECT quantile_cont(delta_x, 0.5) AS mx, quantile_cont(delta_y, 0.5) AS my FROM u) SELECT o_orderkey, CASE WHEN away <= 0.05 AND earth_deg >= 45 AND moon_deg >= 25 THEN 0 WHEN earth_deg >= 45 AND moon_deg >= 25 THEN 1 WHEN away <= 0.05 THEN 2 ELSE 3 END AS tier
FROM u, m ORDER BY tier, round(pow(delta_x - mx, 2) + pow(delta_y - my, 2), 12), o_orderkey LIMIT 1""")
def reference_frame(spark, d):
    k = F.col("o_orderkey")
    s = shifts(spark, d).withColumns({"earth_deg": (k * 31 % 90).cast("double"), "moon_deg": (k * 17 % 60).cast("double"), "delta_x_raw": F.col("delta_x") + k % 13 / 100, "delta_y_raw": F.col("delta_y")})
    # the gate lies between two possible values, which the sum may move in its last digits
    return manifest.choose_reference(s, "o_orderkey", F.col("o_orderstatus") != "P", residual=0.055).select("o_orderkey", "tier")


@query("WITH f AS (SELECT " + TEMPLATE_FILE + " AS path FROM supplier), b AS (SELECT path, lower(regexp_replace(path, '^.*/', '')) AS base FROM f), t AS (SELECT path, base, CAST(regexp_extract(base, '" + TEMPLATE_SQL + "', 8) AS DOUBLE) AS dx, CAST(regexp_extract(base, '" + TEMPLATE_SQL + "', 9) AS DOUBLE) AS dy FROM b WHERE regexp_matches(base, '" + TEMPLATE_SQL + """')),
g AS (SELECT n_nationkey AS group_id, (n_nationkey % 10 - 4) / 100.0::DOUBLE AS group_dx, (n_nationkey % 4) / 100.0::DOUBLE AS group_dy FROM nation),
m AS (SELECT group_id, arg_min(path, (base NOT LIKE '%.fits.gz', NOT contains(base, printf('_dx%.3f_dy%.3f', group_dx, group_dy)), path)) AS path FROM g JOIN t ON abs(dx - group_dx) <= 1e-4 AND abs(dy - group_dy) <= 1e-4 GROUP BY group_id)
SELECT group_id, path FROM g LEFT JOIN m USING (group_id)""")
def template_match(spark, d):
    k = F.col("n_nationkey")
    groups = T(spark, d, "nation").select(k.alias("group_id"), ((k % 10 - 4) / 100).alias("group_dx"), (k % 4 / 100).alias("group_dy"))
    return manifest.match_templates(groups, T(spark, d, "supplier").select(F.expr(TEMPLATE_FILE).alias("path")), "path").select("group_id", "path")


@query("""WITH p AS (SELECT p_partkey, 2136 AS nx, 2078 AS ny, ['full', 'tl', 'tr', 'bl', 'br'][p_partkey % 5 + 1] AS mode, CASE WHEN p_partkey % 3 = 0 THEN p_size * 60 - 300 END AS x0, p_size * 40 AS c FROM part),
b AS (SELECT *, CASE WHEN x0 IS NOT NULL THEN x0 WHEN mode = 'full' THEN 0 WHEN mode LIKE '%r' THEN 1068 ELSE 44 END AS a, CASE WHEN x0 IS NOT NULL THEN 2092 WHEN mode = 'full' THEN nx WHEN mode LIKE '%r' THEN 2092 ELSE 1068 END AS b,
 CASE WHEN x0 IS NOT NULL THEN 0 WHEN mode = 'full' THEN 0 WHEN mode LIKE 't%' THEN 1039 ELSE 0 END AS e, CASE WHEN x0 IS NOT NULL THEN 2048 WHEN mode = 'full' THEN ny WHEN mode LIKE 't%' THEN 2048 ELSE 1039 END AS f FROM p),
q AS (SELECT *, greatest(0, least(a, nx - 1)) AS xa, greatest(1, least(b, nx)) AS xb FROM b)
SELECT p_partkey, CASE WHEN xa < xb THEN xa END AS x_min, CASE WHEN xa < xb THEN xb END AS x_max, CASE WHEN xa < xb THEN e END AS y_min, CASE WHEN xa < xb THEN f END AS y_max,
greatest(least(greatest(c - 128, 0), nx - 256), 0) AS box_x, least(nx, greatest(least(greatest(c - 128, 0), nx - 256), 0) + 256) AS box_end, c < 44 OR c >= nx - 44 OR 2 * c >= ny - 30 AS edge FROM q""")
def crop_boxes(spark, d):
    nx, ny, c, k = F.lit(2136), F.lit(2078), F.col("p_size") * 40, F.col("p_partkey")
    mode = F.element_at(F.array(*map(F.lit, ("full", "tl", "tr", "bl", "br"))), (k % 5 + 1).cast("int"))
    none = F.lit(None).cast("int")
    box = wcs.crop_box(nx, ny, mode, [F.when(k % 3 == 0, F.col("p_size") * 60 - 300), none, none, none])
    square = wcs.target_box(nx, ny, c, c, 256)
    return T(spark, d, "part").select("p_partkey", box.alias("b"), square["x_min"].alias("box_x"), square["x_max"].alias("box_end"), wcs.detector_edge(c, 2 * c, 2136, 2078).alias("edge")).select("p_partkey", "b.x_min", "b.x_max", "b.y_min", "b.y_max", "box_x", "box_end", "edge")


@query("WITH m AS (SELECT o_orderkey, CASE o_orderkey % 50 WHEN 1 THEN 8575 WHEN 2 THEN 32768 ELSE o_orderkey * 7919 % 32768 END AS mask FROM orders), f AS (SELECT *, CASE mask WHEN 8575 THEN ['MASK.VALUE'] WHEN 32768 THEN ['MARK.VALUE'] ELSE list_filter(["
    + ", ".join(f"CASE WHEN mask & {b} <> 0 THEN '{n}' END" for n, b in wcs.MASK_BITS.items())
    + "], lambda x: x IS NOT NULL) END AS flags FROM m) SELECT o_orderkey, array_to_string(flags, '|') AS flags, mask AS again, mask & ~32 AS cleared, greatest(o_orderkey % 9, 3) + (greatest(o_orderkey % 9, 3) + 1) % 2 AS odd FROM f")
def mask_flags(spark, d):
    k = F.col("o_orderkey")
    mask = F.when(k % 50 == 1, 8575).when(k % 50 == 2, 32768).otherwise(k * 7919 % 32768).cast("int")
    m = T(spark, d, "orders").select("o_orderkey", mask.alias("mask"))
    flags = wcs.mask_flags(F.col("mask"))
    return m.select("o_orderkey", F.array_join(flags, "|").alias("flags"), wcs.mask_of_flags(flags).alias("again"), wcs.clear_bit(F.col("mask")).alias("cleared"), wcs.odd_window(k % 9).alias("odd"))


@query("""WITH p AS (SELECT s_suppkey, radians(-0.002 * (s_suppkey % 100 - 50.0) + 0.0001 * (s_suppkey % 37 - 20.0)) AS x, radians(0.002 * (s_suppkey % 37 - 20.0)) AS y FROM supplier), q AS (SELECT *, cos(radians(30)) - y * sin(radians(30)) AS b FROM p),
w AS (SELECT s_suppkey, ((degrees(atan2(x, b)) + 200) % 360 + 360) % 360 AS ra, degrees(atan2(sin(radians(30)) + y * cos(radians(30)), sqrt(x * x + b * b))) AS dec FROM q)
SELECT s_suppkey, round(ra, 7) AS ra, round(dec, 7) AS dec, round(((ra + 180 - 200) % 360 + 360) % 360, 7) AS moved, round(1 + 2 * (s_suppkey % 10) + 3 * (s_suppkey % 7) * (s_suppkey % 10) , 6) AS surface FROM w""")
def linear_sky(spark, d):
    k = F.col("s_suppkey")
    ra, dec = wcs.Tan(200.0, 30.0, 50.0, 20.0, (1.0, -0.05, 0.0, 1.0), (-0.002, 0.002)).sky(k % 100 * 1.0, k % 37 * 1.0)
    # terms in order: 1, y, y2, x, xy, x2
    surface = wcs.polynomial(k % 7 * 1.0, k % 10 * 1.0, [1, 2, 0, 0, 3, 0], 2)
    r7 = lambda c: F.round(c, 7)
    return T(spark, d, "supplier").select("s_suppkey", r7(ra).alias("ra"), r7(dec).alias("dec"), r7(wcs.shift_to_middle(ra, F.lit(200.0))).alias("moved"), r6(surface).alias("surface"))


@query("""WITH b AS (SELECT l_orderkey, sum(w) FILTER (v IS NOT NULL) AS total, sum(v * w) AS s, sum(pow(w * l_tax, 2)) AS e FROM (SELECT l_orderkey, l_tax, l_linenumber * 0.1::DOUBLE AS w, CASE WHEN l_linenumber <> 3 THEN l_quantity END AS v FROM lineitem) GROUP BY l_orderkey)
SELECT l_orderkey, round(s / total, 6) AS flux, round(sqrt(e) / total, 8) AS noise FROM b""")
def combined_bands(spark, d):
    n = F.col("l_linenumber")
    rows = T(spark, d, "lineitem").select("l_orderkey", F.when(n != 3, F.col("l_quantity")).alias("flux"), F.col("l_tax").alias("noise"), (n * F.lit(0.1)).alias("w"))
    out = pixels.combine_bands(rows, ["l_orderkey"], "flux", "noise", "w")
    return out.select("l_orderkey", r6(F.col("flux")).alias("flux"), F.round("noise", 8).alias("noise"))


@query("""WITH p AS (SELECT l_orderkey % 130 AS x, l_partkey % 67 AS y, avg(l_quantity) AS value FROM lineitem GROUP BY ALL)
SELECT x // 8 AS bx, y // 8 AS by, round(avg(value), 6) AS mean, count(*) AS n FROM p WHERE x < 128 AND y < 64 GROUP BY ALL""")
def whole_blocks(spark, d):
    rows = T(spark, d, "lineitem").groupBy((F.col("l_orderkey") % 130).alias("x"), (F.col("l_partkey") % 67).alias("y")).agg(F.avg("l_quantity").alias("value"))
    return pixels.block_reduce(rows, 8, 130, 67).select("bx", "by", r6(F.col("mean")).alias("mean"), "n")


@query(None)
def square_photometry(spark, d):
    k = F.col("s_suppkey")
    plane = T(spark, d, "lineitem").groupBy((F.col("l_orderkey") % 128).alias("x"), (F.col("l_partkey") % 128).alias("y")).agg(F.avg("l_quantity").alias("value"))
    found = pixels.square_photometry(plane, T(spark, d, "supplier").select("s_suppkey", (k * 37 % 128).alias("rx"), (k * 61 % 128).alias("ry")), "s_suppkey", 3, 5, 9)
    return found.select("s_suppkey", *(r6(F.col(c)).alias(c) for c in ("flux", "sky", "flux_wo_sky", "eflux")))


@query(None)
def clipped_savgol(spark, d):
    e = events(spark, d).withColumn("v", F.when(F.col("event_id") % 4 != 0, F.col("value")))
    return sequence.clipped_savgol(e, ["user_id"], "t", "event_id", "v").select("event_id", "segment", r6(F.col("smooth")).alias("smooth"))
