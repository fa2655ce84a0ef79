"""Queries of masks, cells and sky to pixels, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions import wcs
from starloom.operators import cells, masks
from starloom.plans.queries import T, query, r6

NX, NY = 400, 300
STARS = "st AS (SELECT round_even((s_suppkey * 37 % 4000) / 10.0::DOUBLE, 0)::INT AS x, round_even((s_suppkey * 61 % 3000) / 10.0::DOUBLE, 0)::INT AS y, 2 + (s_suppkey * 7 % 160) / 10.0::DOUBLE AS mag FROM supplier), s AS (SELECT * FROM st WHERE x > 0 AND x < 399 AND y > 0 AND y < 299)"
SIZE = "CASE " + " ".join(f"WHEN mag > {b} AND mag <= {f} THEN {n}" for f, b, n in masks.SQUARES) + " END"
CROSS = "CASE " + " ".join(f"WHEN mag {'<' if m == masks.BRIGHT else '<='} {m} THEN [{a}, {b}, {c}]" for m, a, b, c in masks.CROSSES) + " END"
BARS = "SELECT generate_series AS i FROM generate_series(-120, 120)"


def stars(spark, d):
    k = F.col("s_suppkey")
    return T(spark, d, "supplier").select((k * 37 % 4000 / 10).alias("x"), (k * 61 % 3000 / 10).alias("y"), (2 + k * 7 % 160 / 10).alias("mag"))


@query(f"""WITH {STARS}, z AS (SELECT x, y, {SIZE} AS n FROM s WHERE mag < 13), q AS (SELECT DISTINCT x + i AS x, y + j AS y, 1 AS bit FROM z, (SELECT unnest(range(-10, 11)) AS i), (SELECT unnest(range(-10, 11)) AS j) WHERE i >= -((n - 1) // 2) AND i <= n // 2 AND j >= -((n - 1) // 2) AND j <= n // 2),
b AS (SELECT x, y, {CROSS} AS c FROM s WHERE mag < 7), w AS (SELECT DISTINCT x + i AS x, y + j AS y, 2 AS bit FROM b, (SELECT unnest(range(-120, 121)) AS i), (SELECT unnest(range(-120, 121)) AS j)
 WHERE (i * i + j * j <= (c[1] + 1) * (c[1] + 1) AND abs(i) <= c[1] AND abs(j) <= c[1]) OR (i >= -c[3] AND i < c[3] AND j >= -c[2] AND j < c[2]) OR (i >= -c[2] AND i < c[2] AND j >= -c[3] AND j < c[3])),
t AS (SELECT DISTINCT n_nationkey * 20 - 50 + 44 + i AS x FROM nation, (SELECT unnest(range(-3, 4)) AS i) WHERE n_nationkey * 20 - 6 > 0 AND n_nationkey * 20 - 6 < {NX}),
g AS (SELECT x, y FROM (SELECT unnest(range({NX})) AS x), (SELECT unnest(range({NY})) AS y)), m AS (SELECT x, y, bit_or(bit) AS bits FROM (SELECT * FROM q UNION ALL SELECT * FROM w) GROUP BY x, y)
SELECT g.x, g.y, coalesce(bits, 0) | CASE WHEN t.x IS NOT NULL THEN 4 ELSE 0 END | CASE WHEN g.x + 20 < 44 OR g.x + 20 >= 440 - 44 OR g.y >= 310 - 30 THEN 8 ELSE 0 END AS mask FROM g LEFT JOIN m ON m.x = g.x AND m.y = g.y LEFT JOIN t ON t.x = g.x""")
def catalogue_mask(spark, d):
    grid = spark.range(NX * NY).select((F.col("id") % NX).cast("int").alias("x"), F.floor(F.col("id") / NX).cast("int").alias("y"))
    straps = T(spark, d, "nation").select((F.col("n_nationkey") * 20).alias("column"))
    mask = masks.catalogue_mask(grid, stars(spark, d), None, straps, NX, NY, offset=50)
    return masks.with_edges_and_coverage(mask, 20, 0, 440, 310).select("x", "y", "mask")


@query("""SELECT l_suppkey - 3 AS pix, round(sum(l_quantity) FILTER (l_linenumber & 6 = 0), 6) AS total, count(*) FILTER (l_linenumber & 6 = 0) AS n, count(*) FILTER (l_linenumber & 6 <> 0) AS n_masked FROM lineitem WHERE l_suppkey >= 3 GROUP BY l_suppkey""")
def pixel_sums(spark, d):
    rows = T(spark, d, "lineitem").select((F.col("l_suppkey") - 3).alias("pix"), "l_quantity", "l_linenumber", (F.col("l_orderkey") % 5).alias("part"))
    parts = masks.pixel_sums(rows, "pix", "l_quantity", "l_linenumber", [1, 2], ["part"])
    return masks.merge_sums(parts, "pix").withColumn("total", r6(F.col("total")))


@query("""WITH t AS (SELECT p_partkey, unnest(regexp_split_to_array(concat_ws('/', p_brand, ' ' || p_name || ' ,', p_brand), '[/,]')) AS c FROM part) SELECT DISTINCT p_partkey, trim(c) AS neighbour FROM t WHERE trim(c) <> ''""")
def padding_cells(spark, d):
    rows = T(spark, d, "part").select("p_partkey", F.col("p_brand").alias("pad_skycell_top"), F.concat(F.lit(" "), "p_name", F.lit(" ,/"), "p_brand").alias("pad_skycell_left"))
    found = cells.padding(rows, "p_partkey", ["top", "left"])
    return cells.neighbours(found.withColumn("p_partkey", F.col("p_partkey").cast("string")), "p_partkey").withColumn("p_partkey", F.col("p_partkey").cast("long"))


@query("""WITH c AS (SELECT n_regionkey, n_nationkey // 7 AS row, n_nationkey AS cell FROM nation) SELECT *, dense_rank() OVER (PARTITION BY n_regionkey ORDER BY row) - 1 AS row_index, row_number() OVER (PARTITION BY n_regionkey, row ORDER BY cell) - 1 AS cell_index FROM c""")
def cell_places(spark, d):
    rows = T(spark, d, "nation").select("n_regionkey", F.floor(F.col("n_nationkey") / 7).alias("row"), F.col("n_nationkey").alias("cell"))
    return cells.cell_places(rows, "n_regionkey", "row", "cell")


@query("""WITH c AS (SELECT n_regionkey AS proj, n_nationkey // 7 AS row, 'c' || n_nationkey AS cell FROM nation), r AS (SELECT DISTINCT proj, row FROM c), n AS (SELECT proj, row, lead(row) OVER (PARTITION BY proj ORDER BY row) AS after FROM r),
u AS (SELECT n.proj, n.row, c.cell FROM n JOIN c ON c.proj = n.proj AND (c.row = n.row OR c.row = n.after)) SELECT proj, row, cell, count(*) OVER (PARTITION BY proj, cell) AS uses FROM u""")
def row_sources(spark, d):
    rows = T(spark, d, "nation").select(F.col("n_regionkey").alias("proj"), F.floor(F.col("n_nationkey") / 7).alias("row"), F.concat(F.lit("c"), "n_nationkey").alias("cell"))
    return cells.row_sources(rows, "proj", "row", "cell")


@query("""WITH m AS (SELECT l_suppkey, l_orderkey % 1000 AS x, l_partkey % 1000 AS y, CASE WHEN l_quantity > 48 THEN 1 ELSE -1 END AS v FROM lineitem)
SELECT l_suppkey, coalesce(bool_or(v <> -1 AND y >= 940 AND y < 990 AND x >= 10 AND x < 990), false) AS top, coalesce(bool_or(v <> -1 AND x >= 10 AND x < 60 AND y >= 10 AND y < 990), false) AS left, coalesce(bool_or(v <> -1 AND x >= 940 AND x < 990 AND y >= 10 AND y < 60), false) AS bottom_right FROM m GROUP BY l_suppkey""")
def border_strips(spark, d):
    m = T(spark, d, "lineitem").select("l_suppkey", (F.col("l_orderkey") % 1000).alias("x"), (F.col("l_partkey") % 1000).alias("y"), F.when(F.col("l_quantity") > 48, 1).otherwise(-1).alias("value"))
    return cells.border_strips(m, ["l_suppkey"], 1000, 1000, 50, 10).select("l_suppkey", "top", "left", "bottom_right")


QUAD = [(0.2, 0.1), (6.3, 1.0), (5.1, 4.4), (-1.5, 3.0)]
EDGE_SQL = " + ".join(
    f"CASE WHEN y > {min(y1, y2)} + oy AND y <= {max(y1, y2)} + oy AND x <= {max(x1, x2)} + ox AND x <= (y - {y1} - oy) * ({x2} - {x1}) / ({y2} - {y1}) + {x1} + ox THEN 1 ELSE 0 END"
    for (x1, y1), (x2, y2) in zip(QUAD, QUAD[1:] + QUAD[:1])
)


@query(f"""WITH q AS (SELECT s_suppkey, (s_suppkey * 37 % 400)::DOUBLE AS ox, (s_suppkey * 61 % 300)::DOUBLE AS oy FROM supplier), p AS (SELECT s_suppkey, ox, oy, ox + i AS x, oy + j AS y FROM q, (SELECT unnest(range(-3, 9)) AS i), (SELECT unnest(range(-2, 8)) AS j))
SELECT s_suppkey, x::INT AS x, y::INT AS y FROM p WHERE x >= 0 AND x < {NX} AND y >= 0 AND y < {NY} AND ({EDGE_SQL}) % 2 = 1""")
def pixels_inside(spark, d):
    k = F.col("s_suppkey")
    corners = F.array(*(F.struct((k * 37 % 400 + x).alias("x"), (k * 61 % 300 + y).alias("y")) for x, y in QUAD))
    return cells.pixels_inside(T(spark, d, "supplier").select("s_suppkey", corners.alias("corners")), "corners", NX, NY).select("s_suppkey", "x", "y")


@query("""WITH s AS (SELECT s_suppkey, radians((s_suppkey % 50) / 10.0::DOUBLE - 2) AS a, radians(30 + (s_suppkey * 7 % 50) / 10.0::DOUBLE - 2) AS d FROM supplier), c AS (SELECT *, sin(radians(30)) * sin(d) + cos(radians(30)) * cos(d) * cos(a) AS q FROM s),
u AS (SELECT s_suppkey, degrees(cos(d) * sin(a) / q) AS u, degrees((cos(radians(30)) * sin(d) - sin(radians(30)) * cos(d) * cos(a)) / q) AS v FROM c)
SELECT s_suppkey, round(u / -0.01 + 100, 5) AS x, round(v / 0.01 + 50, 5) AS y FROM u""")
def sky_pixels(spark, d):
    k = F.col("s_suppkey")
    x, y = wcs.pixel(200 + k % 50 / 10 - 2, 30 + k * 7 % 50 / 10 - 2, 200.0, 30.0, 100.0, 50.0, (-0.01, 0.0, 0.0, 0.01))
    return T(spark, d, "supplier").select("s_suppkey", F.round(x, 5).alias("x"), F.round(y, 5).alias("y"))
