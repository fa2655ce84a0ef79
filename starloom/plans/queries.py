"""Queries of the sky-survey operators on the driver's tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import names, scalars
from starloom.operators import manifest, masks, runstate, select, sequence, spatial, stats
from starloom.sources import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
T = tables.table


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def r6(c: Column) -> Column:
    return F.round(c, 6)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", scalars.epoch_seconds(F.col("ts")).alias("t"))


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY (event_type = 'purchase') DESC, event_id) k FROM events)
SELECT user_id, event_id, event_type FROM r WHERE k = 1""")
def dedup_prefer(spark, d):
    e = T(spark, d, "events").select("user_id", "event_id", "event_type")
    return select.keep_one(e, ["user_id"], [F.col("event_type") != "purchase", "event_id"])


@query("""SELECT c_custkey, trim(substr(c_name, 1, 8)) AS prefix, try_cast(trim(substr(c_name, 10, 9)) AS BIGINT) AS number FROM customer""")
def fixed_width_parse(spark, d):
    return tables.fixed_width(T(spark, d, "customer"), "c_name", [("prefix", 1, 8, "string"), ("number", 10, 9, "long")]).select("c_custkey", "prefix", "number")


@query("""SELECT token, count(*) AS n FROM (SELECT trim(unnest(string_split(p_type, ' '))) AS token FROM part) WHERE token <> '' GROUP BY token""")
def explode_tokens(spark, d):
    return tables.tokens(T(spark, d, "part").select("p_type"), "p_type", " ").groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT doc_id, lower(CAST(quality AS VARCHAR)) IN ('true', '1') AS good FROM labels WHERE lower(CAST(toxic AS VARCHAR)) NOT IN ('true', 'yes', '1', 't')""")
def truthy_filter(spark, d):
    rows = T(spark, d, "labels").where(~scalars.truthy(F.col("toxic"), ("true", "yes", "1", "t")))
    return rows.select("doc_id", scalars.truthy(F.col("quality")).alias("good"))


@query("""SELECT l_orderkey, l_linenumber, l_quantity - 10 AS x, l_extendedprice - 20000 AS y FROM lineitem
WHERE l_quantity >= 10 AND l_quantity < 30 AND l_extendedprice >= 20000 AND l_extendedprice < 40000""")
def box_filter_rebase(spark, d):
    rows = T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"))
    return select.in_box(rows, {"x": (10, 30), "y": (20000, 40000)})


def sky(df: DataFrame, key: str) -> DataFrame:
    """Positions from keys, as the tables have none."""
    return df.withColumns({"ra": (F.col(key) * 37 % 3600) / 10, "dec": (F.col(key) * 17 % 1600) / 10 - 80})


@query("""WITH s AS (SELECT s_suppkey, (s_suppkey * 37 % 3600) / 10.0::DOUBLE AS ra, (s_suppkey * 17 % 1600) / 10.0::DOUBLE - 80 AS dec FROM supplier),
a AS (SELECT s_suppkey, round(2 * asin(sqrt(least(1.0, pow(sin(radians(dec - 10) / 2), 2) + cos(radians(10)) * cos(radians(dec)) * pow(sin(radians(ra - 120) / 2), 2)))) * 180 / pi(), 6) AS angle FROM s)
SELECT * FROM a WHERE angle <= 60""")
def cone_filter(spark, d):
    s = sky(T(spark, d, "supplier"), "s_suppkey")
    angle = r6(scalars.haversine(F.lit(120.0), F.lit(10.0), F.col("ra"), F.col("dec"))).alias("angle")
    return s.select("s_suppkey", angle).where("angle <= 60")


@query("""SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def early_stop_topn(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return select.first_valid(o, F.col("o_orderstatus") == "F", [F.desc("o_totalprice"), "o_orderkey"], 20).select("o_orderkey", "o_totalprice")


@query("""WITH c AS (SELECT c_custkey, 0.02 + (c_nationkey % 5) * 0.002 AS kernel FROM customer WHERE c_nationkey % 7 <> 0),
r AS (SELECT quantile_cont(kernel, 0.5) AS ref FROM c)
SELECT e.event_id, e.value AS flux_uncal, round(coalesce(e.value * r.ref / c.kernel, e.value), 6) AS flux, round(20 - 2.5 * log10(nullif(greatest(e.value, 0), 0)), 6) AS mag
FROM events e CROSS JOIN r LEFT JOIN c ON e.user_id = c.c_custkey""")
def calib_left_join(spark, d):
    c = T(spark, d, "customer").where("c_nationkey % 7 <> 0").select("c_custkey", (F.lit(0.02) + (F.col("c_nationkey") % 5) * F.lit(0.002)).alias("kernel"))
    ref = stats.quantile(c.select(F.lit(1).alias("one"), "kernel"), ["one"], "kernel", name="ref").select("ref")  # one row
    e = T(spark, d, "events").join(c, F.col("user_id") == F.col("c_custkey"), "left").join(F.broadcast(ref))
    v = F.col("value")
    return e.select("event_id", v.alias("flux_uncal"), r6(F.coalesce(v * F.col("ref") / F.col("kernel"), v)).alias("flux"), r6(scalars.magnitude(v, F.lit(20.0))).alias("mag"))


@query("""WITH u AS (SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY o_custkey)
SELECT c_custkey, coalesce(status, '') AS status FROM customer LEFT JOIN u ON c_custkey = o_custkey""")
def update_join_last_wins(spark, d):
    results = T(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("id"), "o_orderkey", "o_orderstatus")
    return manifest.update_last(T(spark, d, "customer").select("c_custkey"), F.col("c_custkey").cast("string"), results, "id", "o_orderkey", {"o_orderstatus": "status"}, {"status": ""})


@query("""SELECT c_custkey, coalesce(min(o_orderkey), -1) AS first_order FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""")
def lookup_default(spark, d):
    first = T(spark, d, "orders").groupBy("o_custkey").agg(F.min("o_orderkey").alias("first_order"))
    return T(spark, d, "customer").join(first, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("first_order", F.lit(-1)).alias("first_order"))


@query("""SELECT p_partkey FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R')""")
def expected_missing(spark, d):
    seen = T(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey"))
    return runstate.missing(T(spark, d, "part").select("p_partkey"), seen, ["p_partkey"])


PLANE = "(s_suppkey * 7919 % 1000) / 10.0::DOUBLE AS x, (s_suppkey * 104729 % 1000) / 10.0::DOUBLE AS y"


@query(f"""WITH s AS (SELECT s_suppkey, {PLANE} FROM supplier),
c AS (SELECT c_custkey, (c_custkey * 7919 % 1000) / 10.0::DOUBLE AS rx, (c_custkey * 104729 % 1000) / 10.0::DOUBLE AS ry FROM customer)
SELECT s_suppkey FROM s WHERE NOT EXISTS (SELECT 1 FROM c WHERE pow(x - rx, 2) + pow(y - ry, 2) <= 1)""")
def isolation_anti(spark, d):
    plane = lambda k, x, y: ((F.col(k) * 7919 % 1000 / 10).alias(x), (F.col(k) * 104729 % 1000 / 10).alias(y))
    stars = T(spark, d, "customer").select(*plane("c_custkey", "rx", "ry"))
    return spatial.within(T(spark, d, "supplier").select("s_suppkey", *plane("s_suppkey", "x", "y")), stars, 1.0, "left_anti").select("s_suppkey")


@query("""SELECT round_even(l_quantity / 7, 0) * 7 AS l_quantity_cell, round_even(l_discount / 0.03, 0) * 0.03::DOUBLE AS l_discount_cell, count(*) AS n FROM lineitem GROUP BY 1, 2""")
def grid_groups(spark, d):
    return stats.snap_groups(T(spark, d, "lineitem"), {"l_quantity": 7.0, "l_discount": 0.03})


@query("""SELECT o_orderpriority, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order, count(*) AS n FROM orders GROUP BY o_orderpriority""")
def group_summary(spark, d):
    return select.first_of_group(T(spark, d, "orders"), ["o_orderpriority"], ["o_orderdate", "o_orderkey"], "o_orderkey", "first_order")


CLIP_STEP = """, b{i} AS (SELECT l_returnflag, quantile_cont(x, 0.5) - 1.5 * stddev_pop(x) AS lo, quantile_cont(x, 0.5) + 1.5 * stddev_pop(x) AS hi
FROM r LEFT JOIN b{j} USING (l_returnflag) WHERE lo IS NULL OR x BETWEEN lo AND hi GROUP BY l_returnflag)"""


@query(
    "WITH r AS (SELECT l_returnflag, l_extendedprice AS x FROM lineitem), b0 AS (SELECT NULL::VARCHAR AS l_returnflag, NULL::DOUBLE AS lo, NULL::DOUBLE AS hi WHERE false)"
    + "".join(CLIP_STEP.format(i=i, j=i - 1) for i in range(1, 6))
    + " SELECT l_returnflag, round(avg(x), 4) AS clipped_mean, count(*) AS n FROM r JOIN b5 USING (l_returnflag) WHERE x BETWEEN lo AND hi GROUP BY l_returnflag"
)
def sigma_clip_mean(spark, d):
    out = stats.sigma_clip_mean(T(spark, d, "lineitem").select("l_returnflag", "l_extendedprice"), ["l_returnflag"], "l_extendedprice", 1.5)
    return out.withColumn("clipped_mean", F.round("clipped_mean", 4))


@query("""WITH s AS (SELECT event_type, avg(value) AS m, stddev_pop(value) AS s FROM events GROUP BY event_type)
SELECT event_type, count(*) AS n FROM events JOIN s USING (event_type) WHERE abs(value - m) <= 1.5 * s GROUP BY event_type""")
def one_pass_clip(spark, d):
    e = T(spark, d, "events").select("event_type", "value")
    return stats.one_pass_clip(e, ["event_type"], "value", 1.5).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH m AS (SELECT l_returnflag, quantile_cont(l_quantity, 0.5) AS median FROM lineitem GROUP BY l_returnflag)
SELECT l_returnflag, median, round(1.4826 * quantile_cont(abs(l_quantity - median), 0.5), 6) AS sigma FROM lineitem JOIN m USING (l_returnflag) GROUP BY l_returnflag, median""")
def robust_mad(spark, d):
    out = stats.robust_sigma(T(spark, d, "lineitem").select("l_returnflag", "l_quantity"), ["l_returnflag"], "l_quantity")
    return out.withColumn("sigma", r6(F.col("sigma")))


@query("""SELECT l_suppkey, round(sum(l_quantity) FILTER (l_linenumber & 2 = 0), 6) AS total, count(*) FILTER (l_linenumber & 2 = 0) AS n, count(*) FILTER (l_linenumber & 2 <> 0) AS n_masked FROM lineitem GROUP BY l_suppkey""")
def masked_groupby(spark, d):
    out = stats.masked_sums(T(spark, d, "lineitem"), ["l_suppkey"], "l_quantity", F.col("l_linenumber").bitwiseAND(2) != 0)
    return out.withColumn("total", r6(F.col("total")))


@query("""SELECT l_orderkey, bit_or(1 << l_linenumber) AS mask FROM lineitem GROUP BY l_orderkey""")
def bit_or_masks(spark, d):
    return masks.combined(T(spark, d, "lineitem"), ["l_orderkey"], F.expr("shiftleft(1, l_linenumber)"))


@query("""SELECT ceil((p_retailprice - 900) / 200)::INT AS bin, count(*) AS n FROM part WHERE p_retailprice > 900 GROUP BY 1""")
def mag_bins(spark, d):
    bins = F.ceil((F.col("p_retailprice") - 900) / 200).cast("int").alias("bin")
    return T(spark, d, "part").where("p_retailprice > 900").groupBy(bins).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT l_returnflag, round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 4) AS mean, round(sqrt(1 / sum(l_quantity)), 8) AS error FROM lineitem GROUP BY l_returnflag""")
def weighted_bands(spark, d):
    w, x = F.col("l_quantity"), F.col("l_extendedprice")
    return T(spark, d, "lineitem").groupBy("l_returnflag").agg(F.round(F.sum(x * w) / F.sum(w), 4).alias("mean"), F.round(F.sqrt(1 / F.sum(w)), 8).alias("error"))


@query("""SELECT l_orderkey // 64 AS by, l_partkey // 64 AS bx, round(sum(l_quantity), 6) AS total, count(*) AS n FROM lineitem GROUP BY 1, 2""")
def block_reduce(spark, d):
    cell = [F.floor(F.col(k) / 64).cast("long").alias(n) for k, n in (("l_orderkey", "by"), ("l_partkey", "bx"))]
    return T(spark, d, "lineitem").groupBy(*cell).agg(r6(F.sum("l_quantity")).alias("total"), F.count(F.lit(1)).alias("n"))


@query("""SELECT label, k AS place, round(quantile_cont(v, 0.5), 6) AS median FROM (SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS k FROM embeddings) GROUP BY 1, 2""")
def group_median_vec(spark, d):
    out = stats.vector_median(T(spark, d, "embeddings"), ["label"], "embedding")
    return out.withColumn("median", r6(F.col("median")))


@query("""SELECT c_custkey, round(c_acctbal / (SELECT max(c_acctbal) FROM customer), 6) AS ratio FROM customer""")
def ratio_to_max(spark, d):
    c = T(spark, d, "customer").select("c_custkey", "c_acctbal")
    return stats.ratio_to_largest(c, "c_acctbal", "ratio").select("c_custkey", r6(F.col("ratio")).alias("ratio"))


STEPS = """WITH e AS (SELECT event_id, user_id, value, epoch_us(ts) / 1e6 AS t FROM events), """


@query(STEPS + """s AS (SELECT *, t - lag(t) OVER (PARTITION BY user_id ORDER BY t, event_id) AS dt FROM e),
m AS (SELECT user_id, quantile_cont(dt, 0.5) AS m FROM s GROUP BY user_id)
SELECT event_id, CAST(sum(CASE WHEN dt > 3 * m THEN 1 ELSE 0 END) OVER (PARTITION BY s.user_id ORDER BY t, event_id) AS BIGINT) AS segment FROM s JOIN m ON s.user_id = m.user_id""")
def gap_segments(spark, d):
    return sequence.gap_segments(events(spark, d), ["user_id"], "t", "event_id").select("event_id", "segment")


@query(STEPS + """k AS (SELECT event_id, user_id, t, CASE WHEN event_id % 4 <> 0 THEN value END AS v FROM e),
w AS (SELECT *, last_value(v IGNORE NULLS) OVER b AS v0, last_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER b AS t0,
 first_value(v IGNORE NULLS) OVER a AS v1, first_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER a AS t1 FROM k
 WINDOW b AS (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT event_id, round(coalesce(v, v0 + (v1 - v0) * (t - t0) / nullif(t1 - t0, 0), CASE WHEN t0 = t1 THEN v0 END), 6) AS filled FROM w""")
def linear_fill(spark, d):
    e = events(spark, d).withColumn("v", F.when(F.col("event_id") % 4 != 0, F.col("value")))
    return sequence.linear_fill(e, ["user_id"], "t", "event_id", "v").select("event_id", r6(F.col("filled")).alias("filled"))


@query(STEPS + """w AS (SELECT event_id, avg(value) OVER (PARTITION BY user_id ORDER BY t RANGE BETWEEN 86400.0 PRECEDING AND 86400.0 FOLLOWING) AS m FROM e)
SELECT event_id, round(m, 6) AS mean FROM w""")
def centered_mean(spark, d):
    return events(spark, d).select("event_id", r6(sequence.centred_mean(["user_id"], "t", "value", 86400)).alias("mean"))


@query(STEPS + """w AS (SELECT event_id, quantile_cont(value, 0.5) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS m FROM e)
SELECT event_id, round(m, 6) AS median FROM w""")
def rolling_median(spark, d):
    w = sequence.moving(["user_id"], "t", "event_id", 3, 3)
    return events(spark, d).select("event_id", r6(F.percentile("value", F.lit(0.5)).over(w)).alias("median"))


def savgol_sql(window: int, order: int) -> str:
    """CASE over places i in keys of n rows, with the fit's weights as constants."""
    cases = []
    for size in range(order + 1 + order % 2, window + 1, 2):
        weights, half = sequence.savgol_weights(size, order), size // 2
        terms = lambda row, first: " + ".join(f"({float(x)!r}::DOUBLE) * lead(value, {first + k}) OVER w" for k, x in enumerate(weights[row]))  # noqa: B023, E731
        rows = "n >= {0}" if size == window else "n BETWEEN {0} AND {0} + 1"
        cases += [f"WHEN {rows.format(size)} AND i = {k} THEN {terms(k, -k)}" for k in range(half)]
        cases += [f"WHEN {rows.format(size)} AND i = n - 1 - {k} THEN {terms(size - 1 - k, k - size + 1)}" for k in range(half)]
        cases.append(f"WHEN {rows.format(size)} THEN {terms(half, -half)}")
    return f"CASE {' '.join(cases)} ELSE value END"


@query(STEPS + "n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM e), s AS (SELECT event_id, "
    + savgol_sql(5, 2) + " AS smooth FROM n WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)) SELECT event_id, round(smooth, 6) AS smooth FROM s")
def savgol_full(spark, d):
    return sequence.savgol(events(spark, d), ["user_id"], "t", "event_id", "value").select("event_id", r6(F.col("smooth")).alias("smooth"))


@query(STEPS + """r AS (SELECT user_id, arg_min(value, (t, event_id)) AS ref FROM e GROUP BY user_id) SELECT event_id, round(value - ref, 6) AS moved FROM e JOIN r USING (user_id)""")
def reanchor(spark, d):
    e = events(spark, d)
    ref = e.groupBy("user_id").agg(F.min_by("value", F.struct("t", "event_id")).alias("ref"))
    return e.join(ref, "user_id").select("event_id", r6(F.col("value") - F.col("ref")).alias("moved"))


@query("""SELECT o_orderkey, CASE WHEN o_totalprice > 400000 AND o_orderstatus = 'F' THEN 0 WHEN o_totalprice > 400000 THEN 1 WHEN o_orderstatus = 'F' THEN 2 ELSE 3 END AS tier FROM orders ORDER BY tier, o_orderdate, o_orderkey LIMIT 1""")
def tiered_argmin(spark, d):
    big, done = F.col("o_totalprice") > 400000, F.col("o_orderstatus") == "F"
    o = T(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate")
    return select.tiered_first(o, [big & done, big, done], ["o_orderdate", "o_orderkey"]).select("o_orderkey", "tier")


@query("""WITH u AS (SELECT o_orderkey, o_custkey, o_totalprice, 0 AS f FROM orders UNION ALL SELECT o_orderkey, o_custkey, o_totalprice + 1, 1 FROM orders WHERE o_orderstatus = 'O'),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC, f DESC) AS k FROM u) SELECT o_custkey, o_orderkey, round(o_totalprice, 6) AS o_totalprice FROM r WHERE k = 1""")
def union_keep_last(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    new = o.where("o_orderstatus = 'O'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return select.upsert(o, new, ["o_custkey"], "o_orderkey").select("o_custkey", "o_orderkey", r6(F.col("o_totalprice")).alias("o_totalprice"))


@query("""SELECT p_partkey AS k FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 45""")
def set_difference(spark, d):
    return T(spark, d, "part").select(F.col("p_partkey").alias("k")).subtract(T(spark, d, "lineitem").where("l_quantity > 45").select("l_partkey"))


@query(
    "WITH RECURSIVE e(before, after) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in runstate.STAGE_EDGES) + """),
c(stage, ancestor) AS (SELECT after, before FROM e UNION SELECT c.stage, e.before FROM c JOIN e ON c.ancestor = e.after) SELECT stage, ancestor FROM c"""
)
def dag_closure(spark, d):
    return runstate.ancestors(spark.createDataFrame(runstate.STAGE_EDGES, "before string, after string"))


@query(r"""SELECT page_id, regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1) AS host, regexp_extract(url, '/([0-9]+)(?:[?#]|$)', 1) AS number FROM pages""")
def path_ids(spark, d):
    return T(spark, d, "pages").select(
        "page_id", F.regexp_extract("url", "^[A-Za-z]+://([^/?#]*)", 1).alias("host"), F.regexp_extract("url", "/([0-9]+)(?:[?#]|$)", 1).alias("number")
    )


@query(r"""SELECT s_suppkey, printf('s%04d_c%d_k%d_%s', s_suppkey, s_nationkey % 4, s_nationkey % 5, regexp_replace(trim(s_name), '[^\w.-]+', '_', 'g')) AS label FROM supplier""")
def label_format(spark, d):
    return T(spark, d, "supplier").select("s_suppkey", names.target_label(F.col("s_suppkey"), F.col("s_nationkey") % 4, F.col("s_nationkey") % 5, F.col("s_name")).alias("label"))


@query("""WITH m AS (SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 20 - 2.5 * log10(c_acctbal) END AS mag, CASE WHEN c_acctbal > 0 THEN 2.5 / ln(10) * 5 / c_acctbal END AS emag FROM customer)
SELECT c_custkey, round(mag, 6) AS mag, round(emag, 6) AS emag, round(2416 * pow(10, -0.4 * mag), 6) AS jy FROM m""")
def mag_chain(spark, d):
    mag = scalars.magnitude(F.col("c_acctbal"), F.lit(20.0))
    emag = scalars.magnitude_error(F.col("c_acctbal"), F.lit(5.0))
    return T(spark, d, "customer").select("c_custkey", r6(mag).alias("mag"), r6(emag).alias("emag"), r6(scalars.flux_jansky(mag)).alias("jy"))


@query("""SELECT l_orderkey, l_linenumber, round(0.5 + 2 * l_tax * (exp(l_quantity / 10) - exp(-l_quantity / 10)) / 2, 6) AS flux FROM lineitem""")
def sinh_flux(spark, d):
    return T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", r6(scalars.sinh_flux(F.col("l_quantity") / 10, F.lit(0.5), F.col("l_tax"))).alias("flux"))


@query("""WITH p AS (SELECT s_suppkey, radians((s_suppkey % 100) / 10.0::DOUBLE - 5) AS x, radians((s_suppkey * 7 % 100) / 10.0::DOUBLE - 5) AS y, cos(radians(30)) - radians((s_suppkey * 7 % 100) / 10.0::DOUBLE - 5) * sin(radians(30)) AS b FROM supplier),
q AS (SELECT s_suppkey, degrees(atan2(x, b)) + 200 AS ra, degrees(atan2(sin(radians(30)) + y * cos(radians(30)), sqrt(x * x + b * b))) AS dec FROM p)
SELECT s_suppkey, round(ra, 6) AS ra, round(dec, 6) AS dec FROM q""")
def inverse_tan(spark, d):
    ra, dec = scalars.inverse_tangent_plane(F.col("s_suppkey") % 100 / 10 - 5, F.col("s_suppkey") * 7 % 100 / 10 - 5, 200.0, 30.0)
    return T(spark, d, "supplier").select("s_suppkey", r6(ra).alias("ra"), r6(dec).alias("dec"))


@query("""SELECT c_custkey, round(((c_acctbal % 360) + 360) % 360, 6) AS ra FROM customer""")
def ra_wrap(spark, d):
    return T(spark, d, "customer").select("c_custkey", r6(scalars.wrap_degrees(F.col("c_acctbal"))).alias("ra"))


@query("""WITH p AS (SELECT event_id, value AS x, (event_id * 31 % 1000) / 10.0::DOUBLE AS y FROM events)
SELECT event_id FROM p WHERE (CASE WHEN y > 10 AND y <= 90 AND x <= (50 - 10) * (y - 10) / (90 - 10) + 10 THEN 1 ELSE 0 END + CASE WHEN y > 20 AND y <= 90 AND x <= (95 - 50) * (y - 90) / (20 - 90) + 50 THEN 1 ELSE 0 END + CASE WHEN y > 10 AND y <= 20 AND x <= (10 - 95) * (y - 20) / (10 - 20) + 95 THEN 1 ELSE 0 END) % 2 = 1""")
def point_in_polygon(spark, d):
    y = F.col("event_id") * 31 % 1000 / 10
    return T(spark, d, "events").where(scalars.in_polygon(F.col("value"), y, [(10, 10), (50, 90), (95, 20)])).select("event_id")


@query("""SELECT l_suppkey, round(sum(l_quantity) FILTER (l_linenumber <= 2), 6) AS target, round(quantile_cont(l_quantity, 0.5) FILTER (l_linenumber BETWEEN 4 AND 6), 6) AS sky FROM lineitem GROUP BY l_suppkey""")
def aperture_sum(spark, d):
    n, q = F.col("l_linenumber"), F.col("l_quantity")
    sky_level = F.percentile(F.when(n.between(4, 6), q), F.lit(0.5))
    return T(spark, d, "lineitem").groupBy("l_suppkey").agg(r6(F.sum(F.when(n <= 2, q))).alias("target"), r6(sky_level).alias("sky"))


@query("""SELECT l_partkey, l_linenumber, arg_max(l_extendedprice, (l_orderkey, l_suppkey, l_extendedprice)) AS value FROM lineitem GROUP BY l_partkey, l_linenumber""")
def mosaic_last_wins(spark, d):
    return select.last_wins(T(spark, d, "lineitem"), ["l_partkey", "l_linenumber"], ["l_orderkey", "l_suppkey", "l_extendedprice"], "l_extendedprice")


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'R' ELSE o_orderstatus END AS o_orderstatus, o_orderstatus = 'O' AS claimed FROM orders""")
def cas_claim(spark, d):
    return runstate.claim(T(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", "O", "R")


@query("""SELECT event_type, count(*) AS n, min(event_id) AS first_event FROM (SELECT event_type, user_id, min(event_id) AS event_id FROM events GROUP BY event_type, user_id) GROUP BY event_type""")
def idempotent_insert(spark, d):
    once = T(spark, d, "events").groupBy("event_type", "user_id").agg(F.min("event_id").alias("event_id"))
    return once.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"))


@query("""SELECT o_orderkey, count(l_orderkey) AS arrived, coalesce(count(l_orderkey) = max(l_linenumber), false) AS complete FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey""")
def keyed_gather(spark, d):
    lines = T(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.max("l_linenumber").alias("last"))
    o = T(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return o.select("o_orderkey", F.coalesce("n", F.lit(0)).alias("arrived"), F.coalesce(F.col("n") == F.col("last"), F.lit(False)).alias("complete"))


@query("""SELECT p_partkey, substr(sha256('{"brand":"' || p_brand || '","name":"' || p_name || '","type":"' || p_type || '"}'), 1, 16) AS fingerprint FROM part""")
def fingerprint(spark, d):
    return T(spark, d, "part").select("p_partkey", names.fingerprint({"name": F.col("p_name"), "type": F.col("p_type"), "brand": F.col("p_brand")}).alias("fingerprint"))
