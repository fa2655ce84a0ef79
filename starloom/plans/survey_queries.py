"""More queries: closeness joins, moving windows, pixel planes and run state, each with its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions import scalars
from starloom.operators import joins, pixels, runstate, select, sequence, spatial, stats
from starloom.plans.queries import SQL, T, events, query, r6

E = "e AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) / 1e6 AS t FROM events)"
PLANE = "p AS (SELECT l_orderkey % 128 AS x, l_partkey % 128 AS y, avg(l_quantity) AS value FROM lineitem GROUP BY ALL)"


def plane(spark, d) -> DataFrame:
    rows = T(spark, d, "lineitem").select((F.col("l_orderkey") % 128).alias("x"), (F.col("l_partkey") % 128).alias("y"), "l_quantity")
    return rows.groupBy("x", "y").agg(F.avg("l_quantity").alias("value"))


def stars(spark, d) -> DataFrame:
    k = F.col("s_suppkey")
    return T(spark, d, "supplier").select("s_suppkey", (k * 37 % 1000).alias("rx"), (k * 61 % 1000).alias("ry"))


@query("""SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders WHERE o_totalprice > 100000 AND o_orderdate IS NOT NULL GROUP BY o_custkey""")
def required_groups(spark, d):
    o = T(spark, d, "orders").where("o_totalprice > 100000 AND o_orderdate IS NOT NULL").select("o_custkey", "o_orderkey", "o_orderdate")
    return select.keep_one(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("""WITH m AS (SELECT p_partkey, arg_min(s_suppkey, (abs(p_retailprice - s_acctbal), s_suppkey)) AS s_suppkey FROM part JOIN supplier ON abs(p_retailprice - s_acctbal) <= 20 GROUP BY p_partkey)
SELECT p_partkey, coalesce(s_suppkey, -1) AS s_suppkey FROM part LEFT JOIN m USING (p_partkey)""")
def tolerance_match(spark, d):
    p, s = T(spark, d, "part").select("p_partkey", "p_retailprice"), T(spark, d, "supplier").select("s_suppkey", "s_acctbal")
    return joins.best_within(p, s, "p_retailprice", "s_acctbal", 20.0, "p_partkey", "s_suppkey").select("p_partkey", F.coalesce("s_suppkey", F.lit(-1)).alias("s_suppkey"))


@query(f"""WITH {E}, s AS (SELECT user_id, t, max(value) AS v FROM e WHERE event_id % 3 = 0 AND value IS NOT NULL GROUP BY user_id, t),
q AS (SELECT event_id, user_id, t FROM e WHERE event_id % 3 <> 0), a AS (SELECT q.*, s.t AS t0, s.v AS v0 FROM q ASOF LEFT JOIN s ON q.user_id = s.user_id AND q.t >= s.t),
b AS (SELECT a.*, s.t AS t1, s.v AS v1 FROM a ASOF LEFT JOIN s ON a.user_id = s.user_id AND a.t <= s.t)
SELECT event_id, round(CASE WHEN t0 IS NULL THEN v1 WHEN t1 IS NULL OR t1 = t0 THEN v0 ELSE v0 + (v1 - v0) * (t - t0) / (t1 - t0) END, 6) AS value FROM b""")
def interp_join(spark, d):
    e = events(spark, d)
    samples = e.where("event_id % 3 = 0 AND value IS NOT NULL").groupBy("user_id", "t").agg(F.max("value").alias("value"))
    found = joins.interpolate_at(e.where("event_id % 3 != 0").select("event_id", "user_id", "t"), samples, "user_id", "t", "value", 7 * 86400.0)
    return found.select("event_id", r6(F.col("value")).alias("value"))


@query("""WITH p AS (SELECT p_partkey, p_partkey * 17 % 1000 AS x, p_partkey * 29 % 1000 AS y FROM part), s AS (SELECT s_suppkey, s_suppkey * 37 % 1000 AS rx, s_suppkey * 61 % 1000 AS ry FROM supplier)
SELECT p_partkey, arg_min(s_suppkey, ((x - rx) * (x - rx) + (y - ry) * (y - ry), s_suppkey)) AS s_suppkey FROM p LEFT JOIN s ON true GROUP BY p_partkey""")
def nearest_tile(spark, d):
    k = F.col("p_partkey")
    p = T(spark, d, "part").select("p_partkey", (k * 17 % 1000).alias("x"), (k * 29 % 1000).alias("y"))
    return spatial.nearest(p, stars(spark, d), 100.0, "p_partkey", "s_suppkey").select("p_partkey", "s_suppkey")


@query(SQL["nearest_tile"])
def nearest_tile_unbounded(spark, d):
    """The same by a small first radius, which is doubled more often."""
    k = F.col("p_partkey")
    p = T(spark, d, "part").select("p_partkey", (k * 17 % 1000).alias("x"), (k * 29 % 1000).alias("y"))
    return spatial.nearest(p, stars(spark, d), 25.0, "p_partkey", "s_suppkey").select("p_partkey", "s_suppkey")


@query(None)
def greedy_thin(spark, d):
    k = F.col("c_custkey")
    c = T(spark, d, "customer").select("c_custkey", "c_acctbal", (k * 7919 % 10007).alias("x"), (k * 104729 % 10009).alias("y"))
    return spatial.greedy_thin(c, "c_custkey", "c_acctbal", 100.0).select("c_custkey")


@query("""WITH n AS (SELECT n_nationkey, n_regionkey, lead(n_nationkey) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS further FROM nation),
u AS (SELECT n_nationkey AS cell FROM n UNION ALL SELECT further FROM n WHERE further IS NOT NULL) SELECT cell, count(*) AS uses FROM u GROUP BY cell""")
def neighbour_rows(spark, d):
    w = Window.partitionBy("n_regionkey").orderBy("n_nationkey")
    n = T(spark, d, "nation").select(F.array_compact(F.array("n_nationkey", F.lead("n_nationkey").over(w))).alias("cells"))
    return n.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("uses"))


@query("""SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS finished, count(*) FILTER (o_orderstatus = 'O') AS open, count(*) FILTER (o_orderstatus = 'P') AS partial,
CASE WHEN count(*) FILTER (o_orderstatus = 'P') > 0 THEN 'P' WHEN count(*) FILTER (o_orderstatus = 'O') > 0 THEN 'O' ELSE 'F' END AS overall FROM orders GROUP BY o_orderpriority""")
def status_counts(spark, d):
    counts = {n: F.count_if(F.col("o_orderstatus") == s) for n, s in (("finished", "F"), ("open", "O"), ("partial", "P"))}
    overall = F.when(counts["partial"] > 0, "P").when(counts["open"] > 0, "O").otherwise("F")
    return T(spark, d, "orders").groupBy("o_orderpriority").agg(*(c.alias(n) for n, c in counts.items()), overall.alias("overall"))


@query(f"""WITH {E}, b AS (SELECT *, floor((t - min(t) OVER (PARTITION BY event_type)) / 86400)::BIGINT AS bin FROM e),
m AS (SELECT *, median(value) OVER w AS m, count(value) OVER w AS k FROM b WINDOW w AS (PARTITION BY event_type, bin)), s AS (SELECT *, median(abs(value - m)) OVER (PARTITION BY event_type, bin) AS s FROM m),
g AS (SELECT *, coalesce(k < 3 OR abs(value - m) <= 2 * 1.4826::DOUBLE * greatest(s, 1e-12::DOUBLE * (1 + abs(m))), false) AS kept FROM s)
SELECT event_type, bin, round(avg(t) FILTER (kept), 3) AS t_mean, round(round(avg(value) FILTER (kept), 9), 6) AS v_mean, count(value) FILTER (kept) AS n FROM g GROUP BY event_type, bin""")
def binned_clip(spark, d):
    found = stats.binned_clip(events(spark, d), ["event_type"], "t", "value", 86400.0, 2.0)
    return found.select("event_type", "bin", F.round("t_mean", 3).alias("t_mean"), r6(F.round("v_mean", 9)).alias("v_mean"), "n")  # rounded twice: the order of a sum decides no tie


@query(f"""WITH {E}, q AS (SELECT event_id, value, quantile_cont(value, 0.05) OVER w AS lo, quantile_cont(value, 0.8) OVER w AS hi FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING))
SELECT event_id, round(CASE WHEN hi > lo THEN greatest(0.0, least(1.0, (value - lo) / (hi - lo))) END, 6) AS place FROM q""")
def rolling_percentile_norm(spark, d):
    place = sequence.percentile_norm(["user_id"], "t", "event_id", "value", 10, 0.05, 0.8)
    return events(spark, d).select("event_id", r6(place).alias("place"))


@query(f"""WITH {E} SELECT event_id, round((-3 * lag(value, 2) OVER w + 12 * lag(value) OVER w + 17 * value + 12 * lead(value) OVER w - 3 * lead(value, 2) OVER w) / 35, 6) AS smooth
FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)""")
def savgol_interior(spark, d):
    weights = sequence.savgol_weights(5, 2)[2].tolist()
    return events(spark, d).select("event_id", r6(sequence.weighted_window(["user_id"], "t", "event_id", "value", weights)).alias("smooth"))


@query(f"""WITH {E}, s AS (SELECT *, max(value) OVER w - min(value) OVER w AS s FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)),
m AS (SELECT event_id, s, median(value) OVER (w ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS a, median(value) OVER (w ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS b, median(value) OVER (w ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) AS c FROM s WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id))
SELECT event_id, round(CASE WHEN s >= 50 THEN a WHEN s >= 20 THEN b ELSE c END, 6) AS smooth FROM m""")
def adaptive_median(spark, d):
    found = sequence.adaptive_median(events(spark, d), ["user_id"], "t", "event_id", "value", [(50.0, 1), (20.0, 3)], 6)
    return found.select("event_id", r6(F.col("smooth")).alias("smooth"))


@query(f"""WITH {E}, f AS (SELECT event_id, floor(t / 86400) AS frame, value, avg(value) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS smooth FROM e),
r AS (SELECT frame, median(abs(value - smooth)) AS r FROM f GROUP BY frame), m AS (SELECT median(r) AS m FROM r), s AS (SELECT m, 1.4826::DOUBLE * (SELECT median(abs(r - m)) FROM r) AS s FROM m)
SELECT event_id, round(CASE WHEN r > m + 1 * s OR smooth IS NULL THEN value ELSE smooth END, 6) AS chosen FROM f JOIN r USING (frame), s""")
def frame_fallback(spark, d):
    smooth = F.avg("value").over(sequence.moving(["user_id"], "t", "event_id", 3, 3))
    e = events(spark, d).select("event_id", F.floor(F.col("t") / 86400).alias("frame"), "value", smooth.alias("smooth"))
    return sequence.frame_fallback(e, "frame", "value", "smooth", 1.0).select("event_id", r6(F.col("chosen")).alias("chosen"))


@query("""SELECT p_partkey, round((p_size + 2 * p_retailprice / 100) / 3, 6) AS score FROM part ORDER BY (p_size + 2 * p_retailprice / 100) / 3 DESC, p_partkey LIMIT 1""")
def score_argmax(spark, d):
    p = T(spark, d, "part").select("p_partkey", ((F.col("p_size") + 2 * F.col("p_retailprice") / 100) / 3).alias("score"))
    return p.orderBy(F.desc("score"), "p_partkey").limit(1).select("p_partkey", r6(F.col("score")).alias("score"))


@query("""SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('O', 'P') AND (o_orderdate IS NULL OR o_orderdate <= TIMESTAMP '1997-01-01') ORDER BY o_orderdate NULLS FIRST, o_orderkey LIMIT 20""")
def ready_batch(spark, d):
    now = F.lit("1997-01-01 00:00:00").cast("timestamp_ntz")
    return runstate.ready(T(spark, d, "orders"), "o_orderstatus", ["O", "P"], "o_orderdate", now, 20, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "o_orderstatus")


@query("""WITH e AS (SELECT p_partkey, concat('b', p_size % 5, ' - c', p_size % 3, '+d', p_partkey % 2, CASE WHEN p_partkey % 7 = 0 THEN ')' ELSE '' END) AS s FROM part), u AS (SELECT p_partkey, unnest(regexp_extract_all(s, '[+-]?[^+-]+')) AS term FROM e WHERE s NOT LIKE '%)')
SELECT p_partkey, CASE WHEN term[1] = '-' THEN -1 ELSE 1 END AS sign, trim(regexp_replace(term, '^[+-]', '')) AS label FROM u""")
def signed_terms(spark, d):
    text = F.format_string("b%d - c%d+d%d%s", F.col("p_size") % 5, F.col("p_size") % 3, F.col("p_partkey") % 2, F.when(F.col("p_partkey") % 7 == 0, ")").otherwise(""))
    return T(spark, d, "part").select("p_partkey", F.inline(scalars.signed_terms(text)))


@query("""WITH s(stage) AS (VALUES ('F'), ('O'), ('P')), w AS (SELECT c_custkey, stage FROM customer, s) SELECT c_custkey, stage FROM w WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = stage)""")
def cross_fill(spark, d):
    present = T(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderstatus").alias("stage"))
    return runstate.fill_stages(T(spark, d, "customer"), ["F", "O", "P"], present, "c_custkey")


@query("""WITH m AS (SELECT DISTINCT l_orderkey % 1000 AS x, l_partkey % 1000 AS y FROM lineitem WHERE l_quantity >= 49), o AS (SELECT dx, dy FROM (SELECT unnest(range(-2, 3)) AS dx), (SELECT unnest(range(-2, 3)) AS dy) WHERE dx * dx + dy * dy <= 4)
SELECT DISTINCT x + dx AS x, y + dy AS y FROM m, o""")
def dilate_mask(spark, d):
    marked = T(spark, d, "lineitem").where("l_quantity >= 49").select((F.col("l_orderkey") % 1000).alias("x"), (F.col("l_partkey") % 1000).alias("y"))
    return pixels.dilate(marked, pixels.disc(2))


@query("""WITH m AS (SELECT l_linenumber AS plane, l_orderkey % 500 + [0, 3, -2, 1, 1, -4, 2][l_linenumber] AS x, l_partkey % 500 + [0, 1, 4, 0, -3, 2, 2][l_linenumber] AS y, l_quantity AS value FROM lineitem)
SELECT x, y, arg_max(value, (plane, value)) AS value FROM m GROUP BY x, y""")
def offset_mosaic(spark, d):
    planes = T(spark, d, "lineitem").select(F.col("l_linenumber").alias("plane"), (F.col("l_orderkey") % 500).alias("x"), (F.col("l_partkey") % 500).alias("y"), F.col("l_quantity").alias("value"))
    return pixels.mosaic(planes, {1: (0, 0), 2: (3, 1), 3: (-2, 4), 4: (1, 0), 5: (1, -3), 6: (-4, 2), 7: (2, 2)})


@query(f"""WITH {PLANE}, k AS (SELECT dx, dy, CASE WHEN dx = 0 AND dy = 0 THEN 0.5::DOUBLE ELSE 0.0625::DOUBLE END AS w FROM (SELECT unnest(range(-1, 2)) AS dx), (SELECT unnest(range(-1, 2)) AS dy)),
m AS (SELECT x + dx AS x, y + dy AS y, sum(value * w) AS s FROM p, k GROUP BY ALL) SELECT x, y, round(s, 6) AS sum FROM p JOIN m USING (x, y)""")
def kernel_sum(spark, d):
    kernel = {(dx, dy): 0.5 if dx == dy == 0 else 0.0625 for dx in (-1, 0, 1) for dy in (-1, 0, 1)}
    return pixels.convolve(plane(spark, d), kernel).select("x", "y", r6(F.col("sum")).alias("sum"))


WEIGHTS = pixels.gaussian(0.8)


@query(f"""WITH {PLANE}, k AS (SELECT unnest(range({-(len(WEIGHTS) // 2)}, {len(WEIGHTS) // 2 + 1})) AS d, unnest({WEIGHTS!r}::DOUBLE[]) AS w),
m AS (SELECT x + a.d AS x, y + b.d AS y, sum(value * a.w * b.w) AS s FROM p, k a, k b GROUP BY ALL) SELECT x, y, round(s, 6) AS sum FROM p JOIN m USING (x, y)""")
def gaussian_sum(spark, d):
    return pixels.separable(plane(spark, d), WEIGHTS).select("x", "y", r6(F.col("sum")).alias("sum"))


@query(f"""WITH {PLANE}, m AS (SELECT x // 16 AS bx, y // 16 AS by, median(value) AS v FROM p GROUP BY ALL)
SELECT a.bx, a.by, round(median(b.v), 6) AS level FROM m a JOIN m b ON abs(a.bx - b.bx) <= 1 AND abs(a.by - b.by) <= 1 GROUP BY a.bx, a.by""")
def mesh_background(spark, d):
    return pixels.mesh_background(plane(spark, d), 16).select("bx", "by", r6(F.col("level")).alias("level"))


@query(f"""WITH {PLANE}, s AS (SELECT s_suppkey, s_suppkey * 37 % 128 AS rx, s_suppkey * 61 % 128 AS ry FROM supplier),
n AS (SELECT s_suppkey, value, sqrt((x - rx) * (x - rx) + (y - ry) * (y - ry)) AS d FROM p JOIN s ON (x - rx) * (x - rx) + (y - ry) * (y - ry) <= 64),
a AS (SELECT s_suppkey, sum(value) FILTER (d <= 3) AS total, count(value) FILTER (d <= 3) AS n_pix, median(value) FILTER (d >= 5) AS sky FROM n GROUP BY s_suppkey)
SELECT s_suppkey, n_pix, round(sky, 6) AS sky, round(total - n_pix * coalesce(sky, 0), 6) AS flux FROM a WHERE n_pix > 0""")
def aperture_flux(spark, d):
    k = F.col("s_suppkey")
    at = T(spark, d, "supplier").select("s_suppkey", (k * 37 % 128).alias("rx"), (k * 61 % 128).alias("ry"))
    found = pixels.aperture_photometry(plane(spark, d), at, "s_suppkey", 3.0, 5.0, 8.0)
    return found.select("s_suppkey", "n_pix", r6(F.col("sky")).alias("sky"), r6(F.col("flux")).alias("flux"))
