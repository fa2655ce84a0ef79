"""Queries of the run store's statements, with their SQL.  Stage runs are order lines: a run per hundred orders, a target per order, a stage per line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators import state
from starloom.plans.queries import T, query

STATES = ["pending", "ready", "running", "success", "skipped", "failed", "canceled", "blocked", "external"]
EDGES = [("s1", "s2"), ("s2", "s3"), ("s2", "s4"), ("s3", "s5"), ("s4", "s5"), ("s5", "s6"), ("s6", "s7")]
ACTIVE = ["s3", "s5", "s6"]
RUN = "r0"
LINES = "lines AS (SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey, max(l_quantity) AS l_quantity, max(l_returnflag) AS l_returnflag FROM lineitem GROUP BY l_orderkey, l_linenumber), "
S = (
    LINES + "s AS (SELECT 'r' || (l_orderkey // 100 % 10) AS run_id, 't' || l_orderkey AS target_label, 's' || l_linenumber AS stage, ["
    + ", ".join(f"'{x}'" for x in STATES)
    + "][(l_partkey % 9 + 1)::INT] AS status, l_suppkey % 4 AS attempts, CASE WHEN l_suppkey % 3 = 0 THEN 'old' END AS error_tail, l_suppkey AS native_id FROM lines)"
)
# artifacts: one for every line with a quantity over 20
A = "a AS (SELECT 'r' || (l_orderkey // 100 % 10) AS run_id, 't' || l_orderkey AS target_label, 's' || l_linenumber AS stage, l_returnflag AS path FROM lines WHERE l_quantity > 20)"
E = "e(dependency, stage) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in EDGES) + ")"
D = E + ", d(stage, later) AS (SELECT dependency, stage FROM e UNION SELECT d.stage, e.stage FROM d JOIN e ON d.later = e.dependency)"
DONE = "('success', 'skipped')"
U = f"u AS (SELECT s.run_id, s.target_label, s.stage, e.dependency FROM s JOIN e USING (stage) LEFT JOIN s b ON b.run_id = s.run_id AND b.target_label = s.target_label AND b.stage = e.dependency WHERE coalesce(b.status NOT IN {DONE}, true))"
INACTIVE = ", ".join(f"'{x}'" for x in ACTIVE)


def key(name: str):
    return F.concat(F.lit(name), F.col("l_orderkey"))


def run_key():
    return F.concat(F.lit("r"), F.floor(F.col("l_orderkey") / 100) % 10)


def lines(spark, d) -> DataFrame:
    """Order lines with keys of their own."""
    least = [F.min(c).alias(c) for c in ("l_partkey", "l_suppkey")]
    return T(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(*least, F.max("l_quantity").alias("l_quantity"), F.max("l_returnflag").alias("l_returnflag"))


def stage_runs(spark, d) -> DataFrame:
    states = F.array(*map(F.lit, STATES))
    return lines(spark, d).select(
        run_key().alias("run_id"), key("t").alias("target_label"), F.concat(F.lit("s"), "l_linenumber").alias("stage"),
        F.element_at(states, (F.col("l_partkey") % 9 + 1).cast("int")).alias("status"), (F.col("l_suppkey") % 4).alias("attempts"),
        F.when(F.col("l_suppkey") % 3 == 0, "old").alias("error_tail"), F.col("l_suppkey").alias("native_id"),
    )


def artifacts(spark, d) -> DataFrame:
    return lines(spark, d).where("l_quantity > 20").select(
        run_key().alias("run_id"), key("t").alias("target_label"), F.concat(F.lit("s"), "l_linenumber").alias("stage"), F.lit("check").alias("artifact_type"), F.col("l_returnflag").alias("path")
    )


def edges(spark) -> DataFrame:
    return spark.createDataFrame(EDGES, "before string, after string")


@query(f"WITH {S}, {E}, {U} SELECT * FROM u")
def state_unmet(spark, d):
    return state.unmet(stage_runs(spark, d), edges(spark))


@query(f"""WITH {S}, {A}, {E}, {U}, w AS (SELECT s.*, NOT EXISTS (SELECT 1 FROM u WHERE u.run_id = s.run_id AND u.target_label = s.target_label AND u.stage = s.stage) AS ok,
s.stage IN ({INACTIVE}) OR EXISTS (SELECT 1 FROM a WHERE a.run_id = s.run_id AND a.target_label = s.target_label AND a.stage = s.stage) AS may FROM s)
SELECT run_id, target_label, stage, CASE WHEN ok AND may AND status IN ('blocked', 'pending') THEN 'ready' WHEN ok AND status = 'blocked' THEN 'pending' ELSE status END AS status FROM w""")
def state_promote(spark, d):
    rows = stage_runs(spark, d)
    active = rows.select("run_id").distinct().withColumn("stage", F.explode(F.array(*map(F.lit, ACTIVE))))
    return state.promote(rows, edges(spark), artifacts(spark, d), active, "check").select(*state.KEY, "status")


@query(f"""WITH {S}, {A} SELECT s.run_id, s.target_label, s.stage, a.path IS NOT NULL AS attempted, coalesce(a.path = 'N', false) AS complete FROM s LEFT JOIN a USING (run_id, target_label, stage)""")
def state_artifacts(spark, d):
    return state.has_artifact(stage_runs(spark, d), artifacts(spark, d), "check", "N").select(*state.KEY, "attempted", "complete")


@query(f"""WITH {S}, {A} SELECT run_id, target_label, stage FROM s WHERE run_id = '{RUN}' AND status = 'external' AND NOT EXISTS (SELECT 1 FROM a WHERE a.run_id = s.run_id AND a.target_label = s.target_label AND a.stage = s.stage)""")
def state_unchecked(spark, d):
    return state.unchecked_external(stage_runs(spark, d), artifacts(spark, d), RUN, "check").select(*state.KEY)


@query(f"""WITH RECURSIVE {S}, {D}, f AS (SELECT DISTINCT s.run_id, s.target_label, d.later AS stage FROM s JOIN d USING (stage) WHERE s.status = 'failed')
SELECT run_id, target_label, stage, CASE WHEN f.stage IS NOT NULL AND status IN ('pending', 'ready', 'external') THEN 'blocked' ELSE status END AS status FROM s LEFT JOIN f USING (run_id, target_label, stage)""")
def state_block_downstream(spark, d):
    return state.block_downstream(stage_runs(spark, d), edges(spark)).select(*state.KEY, "status")


REOPEN = f"""WITH RECURSIVE {S}, {A}, {D}, f AS (SELECT run_id, target_label, stage FROM s WHERE run_id = '{RUN}' AND status IN ('failed', 'canceled', 'blocked')),
k AS (SELECT * FROM f UNION SELECT f.run_id, f.target_label, d.later FROM f JOIN d USING (stage)) """


@query(REOPEN + f"""SELECT s.run_id, s.target_label, s.stage, CASE WHEN k.stage IS NULL THEN status WHEN s.stage IN ({INACTIVE}) THEN 'pending' ELSE 'external' END AS status,
CASE WHEN k.stage IS NULL THEN attempts ELSE 0 END AS attempts, CASE WHEN k.stage IS NULL THEN error_tail END AS error_tail, CASE WHEN k.stage IS NULL THEN native_id END AS native_id FROM s LEFT JOIN k USING (run_id, target_label, stage)""")
def state_reopen(spark, d):
    return state.reopen(stage_runs(spark, d), RUN, edges(spark), ACTIVE, artifacts(spark, d))[0]


@query(REOPEN + "SELECT a.* FROM a WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.run_id = a.run_id AND k.target_label = a.target_label AND k.stage = a.stage)")
def state_reopen_artifacts(spark, d):
    return state.reopen(stage_runs(spark, d), RUN, edges(spark), ACTIVE, artifacts(spark, d))[1].drop("artifact_type")


@query(f"""WITH {S} SELECT run_id, target_label, stage, CASE WHEN run_id = '{RUN}' AND status IN ('running', 'pending', 'ready', 'blocked', 'external') THEN 'canceled' ELSE status END AS status,
CASE WHEN run_id = '{RUN}' AND status = 'running' THEN 'Canceled by user' ELSE error_tail END AS error_tail, CASE WHEN run_id = '{RUN}' AND status = 'running' THEN NULL ELSE native_id END AS native_id FROM s""")
def state_cancel(spark, d):
    return state.cancel(stage_runs(spark, d), RUN, "2024-01-01").drop("attempts")


@query(f"""WITH {S} SELECT run_id, target_label, stage, CASE WHEN status = 'ready' AND stage = 's2' THEN 'running' ELSE status END AS status, status = 'ready' AND stage = 's2' AS claimed,
attempts + CASE WHEN status = 'ready' AND stage = 's2' THEN 1 ELSE 0 END AS attempts, CASE WHEN status = 'ready' AND stage = 's2' THEN NULL ELSE error_tail END AS error_tail FROM s""")
def state_claim(spark, d):
    return state.claim(stage_runs(spark, d), F.col("stage") == "s2", "token", "2024-01-01").drop("native_id")


@query(f"""WITH {S} SELECT run_id, target_label, stage, CASE WHEN status = 'running' THEN 'ready' ELSE status END AS status, CASE WHEN status = 'running' THEN 'lost' ELSE error_tail END AS error_tail,
CASE WHEN status = 'running' THEN 0 ELSE attempts END AS attempts, CASE WHEN status = 'running' THEN NULL ELSE native_id END AS native_id FROM s""")
def state_requeue(spark, d):
    return state.requeue(stage_runs(spark, d), F.lit(True), "lost", reset_attempts=True)


@query(f"""WITH {S}, {A} SELECT run_id, target_label, stage, CASE WHEN attempts = 3 THEN 'pending' ELSE status END AS status, CASE WHEN attempts = 3 THEN NULL ELSE error_tail END AS error_tail FROM s""")
def state_force_rerun(spark, d):
    rows = stage_runs(spark, d)
    return state.force_rerun(rows, artifacts(spark, d), rows.where("attempts = 3"))[0].select(*state.KEY, "status", "error_tail")


@query(f"""WITH {S} SELECT run_id, target_label, stage, CASE WHEN run_id = '{RUN}' AND status = 'pending' AND stage IN ('s1', 's2', 's4') THEN 'external' ELSE status END AS status FROM s""")
def state_repair(spark, d):
    return state.repair_orphans(stage_runs(spark, d), RUN, ACTIVE, ["s1", "s2", "s3", "s4"]).select(*state.KEY, "status")


@query(f"""WITH {S} SELECT run_id, target_label, stage, CASE WHEN run_id = '{RUN}' AND stage IN ('s4', 's7') AND status NOT IN ('skipped', 'success', 'failed') THEN 'skipped' ELSE status END AS status FROM s""")
def state_not_selected(spark, d):
    return state.skip_not_selected(stage_runs(spark, d), RUN, ACTIVE, ["s1", "s2"], "2024-01-01").select(*state.KEY, "status")


@query(f"""WITH {S}, w AS (SELECT DISTINCT target_label, unnest(['s1', 's2', 's3', 's4', 's5', 's6', 's7']) AS stage FROM s WHERE run_id = '{RUN}')
SELECT run_id, target_label, stage, status FROM s UNION ALL SELECT '{RUN}', target_label, stage, CASE WHEN stage IN ({INACTIVE}) THEN 'pending' ELSE 'external' END FROM w WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.run_id = '{RUN}' AND s.target_label = w.target_label AND s.stage = w.stage)""")
def state_backfill(spark, d):
    rows = stage_runs(spark, d)
    targets = rows.select("run_id", "target_label").distinct()
    return state.backfill(rows, targets, RUN, [f"s{i}" for i in range(1, 8)], ACTIVE).select(*state.KEY, "status")


@query(f"""WITH {S} SELECT target_label, stage, status FROM s WHERE run_id = '{RUN}' AND status IN ('failed', 'canceled', 'running', 'blocked')""")
def state_retryable(spark, d):
    return state.retryable(stage_runs(spark, d), RUN).select("target_label", "stage", "status")


@query(f"""WITH {S} SELECT run_id, CASE WHEN count(*) FILTER (status IN ('running', 'pending', 'ready', 'blocked', 'external')) > 0 THEN 'running' WHEN count(*) FILTER (status = 'failed') > 0 THEN 'failed' WHEN count(*) FILTER (status = 'canceled') > 0 THEN 'canceled' ELSE 'success' END AS status FROM s GROUP BY run_id""")
def state_final(spark, d):
    return state.final_status(stage_runs(spark, d))


@query(f"""WITH {S} SELECT run_id, target_label, stage, status FROM s WHERE status = 'running'""")
def state_running(spark, d):
    return state.running(stage_runs(spark, d)).select(*state.KEY, "status")


@query("""WITH o AS (SELECT DISTINCT 'r' || (o_custkey % 40) AS run_id, o_orderpriority AS event_key FROM orders WHERE o_orderstatus = 'F'), n AS (SELECT DISTINCT 'r' || (c_custkey % 60) AS run_id, '1-URGENT' AS event_key FROM customer)
SELECT *, false AS inserted FROM o UNION ALL SELECT *, true FROM n WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.run_id = n.run_id AND o.event_key = n.event_key)""")
def state_insert_once(spark, d):
    old = T(spark, d, "orders").where("o_orderstatus = 'F'").select(F.concat(F.lit("r"), F.col("o_custkey") % 40).alias("run_id"), F.col("o_orderpriority").alias("event_key")).distinct()
    new = T(spark, d, "customer").select(F.concat(F.lit("r"), F.col("c_custkey") % 60).alias("run_id"), F.lit("1-URGENT").alias("event_key")).distinct()
    return state.insert_once(old, new, ["run_id", "event_key"])


@query("""SELECT o_orderkey AS id, 'r' || (o_custkey % 40) AS run_id FROM orders WHERE o_orderstatus <> 'F' ORDER BY id LIMIT 50""")
def state_commands(spark, d):
    done = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    c = T(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.concat(F.lit("r"), F.col("o_custkey") % 40).alias("run_id"), done.alias("processed_at"))
    return state.pending_commands(c).select("id", "run_id")


@query(f"""WITH {S} SELECT DISTINCT target_label FROM s WHERE run_id = '{RUN}'""")
def state_labels(spark, d):
    rows = stage_runs(spark, d)
    return state.labels(rows, rows.limit(0), RUN)


CLOSURE = ["s1", "s2", "s3", "s4", "s5", "s6"]
NEEDED = f"""v AS (SELECT s.*, s.stage IN ({", ".join(f"'{x}'" for x in CLOSURE)}) AND s.stage NOT IN ({INACTIVE}) AND s.status NOT IN {DONE} AND NOT EXISTS (SELECT 1 FROM e JOIN s b ON b.stage = e.stage
WHERE e.dependency = s.stage AND e.stage <> 's7' AND b.run_id = s.run_id AND b.target_label = s.target_label AND b.status IN {DONE}) AS verify_needed FROM s)"""


@query(f"WITH {S}, {E}, {NEEDED} SELECT run_id, target_label, stage, verify_needed FROM v")
def state_verify_needed(spark, d):
    return state.with_verify_needed(stage_runs(spark, d), edges(spark), ACTIVE, CLOSURE).select(*state.KEY, "verify_needed")


SUPERSEDED = f"""WITH {S}, {A}, {E}, {NEEDED}, r AS (SELECT run_id, target_label, stage, 'not_selected' AS path FROM a WHERE path = 'N'),
h AS (SELECT v.run_id, v.target_label, v.stage FROM v LEFT JOIN r ON r.run_id = v.run_id AND r.target_label = v.target_label AND r.stage = v.stage WHERE v.run_id = '{RUN}' AND v.target_label NOT LIKE '%7'
AND v.stage IN ({", ".join(f"'{x}'" for x in CLOSURE)}) AND v.stage NOT IN ({INACTIVE}) AND NOT v.verify_needed AND NOT (v.status = 'skipped' AND r.path IS NOT NULL) AND v.status NOT IN ('success', 'failed')) """


def superseded(spark, d) -> tuple[DataFrame, DataFrame]:
    rows, reasons = stage_runs(spark, d), artifacts(spark, d).where("path = 'N'").withColumns({"artifact_type": F.lit("skip_reason"), "path": F.lit("not_selected")})
    targets = rows.select("run_id", "target_label").distinct().withColumn("enabled", F.when(F.col("target_label").endswith("7"), 0).otherwise(1))
    return state.skip_superseded(rows, reasons, edges(spark), targets, RUN, ACTIVE, CLOSURE, "now")


@query(SUPERSEDED + "SELECT s.run_id, s.target_label, s.stage, CASE WHEN h.stage IS NOT NULL THEN 'skipped' ELSE status END AS status FROM s LEFT JOIN h USING (run_id, target_label, stage)")
def state_superseded(spark, d):
    return superseded(spark, d)[0].select(*state.KEY, "status")


@query(SUPERSEDED + "SELECT run_id, target_label, stage, path FROM r WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.run_id = r.run_id AND h.target_label = r.target_label AND h.stage = r.stage) UNION ALL SELECT run_id, target_label, stage, 'superseded' FROM h")
def state_superseded_reasons(spark, d):
    return superseded(spark, d)[1].select(*state.KEY, "path")


@query(f"""WITH {S}, k AS (SELECT run_id, target_label, stage FROM s WHERE status = 'failed') SELECT s.run_id, s.target_label, s.stage, CASE WHEN k.stage IS NOT NULL THEN 1 ELSE attempts END AS force_launch FROM s LEFT JOIN k USING (run_id, target_label, stage)""")
def state_force_launch(spark, d):
    rows = stage_runs(spark, d).withColumnRenamed("attempts", "force_launch")
    return state.set_force_launch(rows, rows.where("status = 'failed'"), True).select(*state.KEY, "force_launch")


@query("""WITH c AS (SELECT o_orderkey AS id, 'r' || o_custkey AS run_id, o_orderpriority AS kind, CASE WHEN o_orderstatus = 'F' THEN 'old' END AS processed_at FROM orders), n AS (SELECT 'r' || s_suppkey AS run_id, 'pause' AS kind, s_suppkey FROM supplier)
SELECT id, run_id, kind, CASE WHEN id % 5 = 0 THEN 'now' ELSE processed_at END AS processed_at FROM c UNION ALL SELECT (SELECT max(id) FROM c) + row_number() OVER (ORDER BY s_suppkey), run_id, kind, NULL FROM n""")
def state_commands(spark, d):
    """A command per order, of which every fifth is processed now; one to pause per supplier is added."""
    o, s = T(spark, d, "orders"), T(spark, d, "supplier")
    commands = o.select(F.col("o_orderkey").alias("id"), F.concat(F.lit("r"), "o_custkey").alias("run_id"), F.col("o_orderpriority").alias("kind"), F.lit("{}").alias("args_json"), F.lit("then").alias("created_at"), F.when(F.col("o_orderstatus") == "F", "old").alias("processed_at"))
    new = s.select(F.concat(F.lit("r"), "s_suppkey").alias("run_id"), F.lit("pause").alias("kind"), F.lit(None).cast("string").alias("args_json"), "s_suppkey")
    done = commands.where("id % 5 = 0")
    return state.enqueue_commands(state.mark_processed(commands, done, "now"), new, ["s_suppkey"], "now").select("id", "run_id", "kind", "processed_at")


@query("""SELECT event_id, CAST(floor((epoch_us(TIMESTAMP '2030-01-01') - epoch_us(ts)) / 1e6) AS BIGINT) AS age FROM events""")
def state_ages(spark, d):
    iso = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    age = state.age_seconds(iso, F.lit("2030-01-01 00:00:00").cast("timestamp"))
    return T(spark, d, "events").select("event_id", F.floor(age).alias("age"))
