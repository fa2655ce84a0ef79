"""The run store's statements as table rewrites: each takes whole tables and returns the new one.

Tables: stage_runs (run_id, target_label, stage, status and launch fields), runs (run_id, status, stages, force_rerun ...),
artifacts (run_id, target_label, stage, artifact_type, path), edges (before, after) of the stage graph.  Stage graphs are
tens of rows; everything else may be large and is joined by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators import runstate

KEY = ["run_id", "target_label", "stage"]
#: The states of a stage run.
SATISFIED = ("success", "skipped")
RETRYABLE = ("failed", "canceled", "running", "blocked")
OPEN = ("pending", "ready", "blocked", "external")
REOPENED = ("failed", "canceled", "blocked")
BLOCKABLE = ("pending", "ready", "external")
#: Columns that a new attempt clears.
LAUNCH = ("started_at", "finished_at", "exit_code", "native_id", "launch_token", "claimed_at", "submit_epoch")


def set_where(df: DataFrame, hit: Column, values: dict[str, object]) -> DataFrame:
    """UPDATE ... WHERE: the columns that `df` has, in rows where `hit` is true."""
    hit = F.coalesce(hit, F.lit(False))
    lift = lambda v: v if isinstance(v, Column) else F.lit(v)
    return df.withColumns({c: F.when(hit, lift(v).cast(df.schema[c].dataType)).otherwise(F.col(c)) for c, v in values.items() if c in df.columns})


def cleared(status: str, **more) -> dict[str, object]:
    return {"status": status, **dict.fromkeys(LAUNCH), **more}


def of_run(df: DataFrame, run: str | None, **equal) -> DataFrame:
    """Rows of a run (of all if it is None) with these values: the store's point lookups."""
    out = df if run is None else df.where(F.col("run_id") == run)
    for c, v in equal.items():
        out = out.where(F.col(c).isin(*v) if isinstance(v, (list, tuple)) else F.col(c) == v)
    return out


def running(stage_runs: DataFrame, run: str | None = None) -> DataFrame:
    return of_run(stage_runs, run, status="running")


def failed(stage_runs: DataFrame, run: str) -> DataFrame:
    return of_run(stage_runs, run, status="failed").orderBy("target_label", "stage")


def retryable(stage_runs: DataFrame, run: str) -> DataFrame:
    return of_run(stage_runs, run, status=RETRYABLE).orderBy("target_label", "stage")


def active_runs(runs: DataFrame) -> DataFrame:
    return runs.where(F.col("status") == "running").orderBy("started_at", "run_id")


def latest_runs(runs: DataFrame, limit: int = 20) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), "run_id").limit(limit)


def labels(stage_runs: DataFrame, targets: DataFrame, run: str) -> DataFrame:
    """A run's distinct target labels: those with stage rows, or else its targets."""
    own = of_run(stage_runs, run).select("target_label").distinct().withColumn("__own", F.lit(True))
    both = own.unionByName(of_run(targets, run).select("target_label").distinct().withColumn("__own", F.lit(False)))
    some = own.agg(F.count(F.lit(1)).alias("__n"))  # one row
    return both.join(F.broadcast(some)).where((F.col("__n") == 0) | F.col("__own")).select("target_label").distinct()


def has_artifact(stage_runs: DataFrame, artifacts: DataFrame, kind: str, path: str | None = None) -> DataFrame:
    """Adds `attempted` (an artifact of the kind is there) and `complete` (one with this path is)."""
    value = F.lit(True) if path is None else F.col("path") == path
    found = artifacts.where(F.col("artifact_type") == kind).groupBy(*KEY).agg(F.max(value).alias("__complete"))
    joined = stage_runs.join(found.withColumn("__there", F.lit(True)), KEY, "left")
    out = joined.withColumns({"attempted": F.coalesce("__there", F.lit(False)), "complete": F.coalesce("__complete", F.lit(False))})
    return out.drop("__there", "__complete")


def unchecked_external(stage_runs: DataFrame, artifacts: DataFrame, run: str, kind: str) -> DataFrame:
    """External stages without an artifact of the kind: NOT EXISTS as an anti join."""
    return runstate.missing(of_run(stage_runs, run, status="external"), artifacts.where(F.col("artifact_type") == kind), KEY)


def with_open_deps(stage_runs: DataFrame, edges: DataFrame) -> DataFrame:
    """Adds `__open`: the stages that a row's stage follows and that aren't success or skipped in its target, or have no row.

    A target's few stages meet in one window, so the rows move once and join with nothing but the stage graph.
    """
    target = Window.partitionBy("run_id", "target_label")
    satisfied = F.collect_set(F.when(F.col("status").isin(*SATISFIED), F.col("stage"))).over(target)
    deps = edges.toDF("dependency", "__stage").groupBy("__stage").agg(F.collect_set("dependency").alias("__deps"))  # a stage graph has tens of rows
    joined = stage_runs.withColumn("__satisfied", satisfied).join(F.broadcast(deps), F.col("stage") == F.col("__stage"), "left")
    return joined.withColumn("__open", F.array_except(F.coalesce("__deps", F.array().cast("array<string>")), F.col("__satisfied"))).drop("__satisfied", "__stage", "__deps")


def unmet(stage_runs: DataFrame, edges: DataFrame) -> DataFrame:
    """(run_id, target_label, stage, dependency) of every stage row whose dependency isn't success or skipped, or has no row."""
    return with_open_deps(stage_runs, edges).select(*KEY, F.explode("__open").alias("dependency"))


def with_deps(stage_runs: DataFrame, edges: DataFrame) -> DataFrame:
    """Adds `deps_ok`: are all dependencies success or skipped?"""
    return with_open_deps(stage_runs, edges).withColumn("deps_ok", F.size("__open") == 0).drop("__open")


def promote(stage_runs: DataFrame, edges: DataFrame, artifacts: DataFrame, active: DataFrame, kind: str) -> DataFrame:
    """Blocked rows whose dependencies are met become pending, and pending ones ready if active (run_id, stage) or attempted."""
    rows = has_artifact(with_deps(stage_runs, edges), artifacts, kind)
    rows = rows.join(active.select("run_id", "stage").distinct().withColumn("__active", F.lit(True)), ["run_id", "stage"], "left")
    status = F.when((F.col("status") == "blocked") & F.col("deps_ok"), "pending").otherwise(F.col("status"))
    go = (status == "pending") & F.col("deps_ok") & (F.col("__active").isNotNull() | F.col("attempted"))
    return rows.withColumn("status", F.when(go, "ready").otherwise(status)).select(*stage_runs.columns)


def claim(stage_runs: DataFrame, wanted: Column, token: str, now: str) -> DataFrame:
    """Ready rows that are wanted start running; `claimed` tells which did."""
    hit = wanted & (F.col("status") == "ready")
    values = {"launch_token": token, "claimed_at": now, "started_at": now, "finished_at": None, "exit_code": None, "error_tail": None, "not_before": None}
    values |= {"attempts": F.coalesce("attempts", F.lit(0)) + 1} if "attempts" in stage_runs.columns else {}
    out = set_where(stage_runs.withColumn("claimed", F.coalesce(hit, F.lit(False))), hit, values)
    return set_where(out, F.col("claimed"), {"status": "running"})


def requeue(stage_runs: DataFrame, wanted: Column, error: str, not_before: str | None = None, reset_attempts: bool = False) -> DataFrame:
    values = cleared("ready", error_tail=error, not_before=None if reset_attempts else not_before) | ({"attempts": 0} if reset_attempts else {})
    running_rows = wanted & (F.col("status") == "running")
    later = {k: v for k, v in values.items() if k != "status"}
    return set_where(set_where(stage_runs.withColumn("__hit", F.coalesce(running_rows, F.lit(False))), F.col("__hit"), later), F.col("__hit"), {"status": "ready"}).drop("__hit")


def downstream(edges: DataFrame) -> DataFrame:
    """(stage, later) of every stage and all that follow from it."""
    return runstate.ancestors(edges).select(F.col("ancestor").alias("stage"), F.col("stage").alias("later"))


def below(rows: DataFrame, edges: DataFrame, itself: bool) -> DataFrame:
    """(run_id, target_label, stage) of what follows from these rows, and the rows themselves if asked."""
    seeds = rows.select(*KEY).distinct()
    later = seeds.join(F.broadcast(downstream(edges)), "stage").select("run_id", "target_label", F.col("later").alias("stage"))
    return (later.unionByName(seeds) if itself else later).distinct()


def update_keys(stage_runs: DataFrame, keys: DataFrame, values: dict[str, object], also: Column | None = None) -> DataFrame:
    """The rows with one of the keys, and where `also` holds, get the values."""
    marked = stage_runs.join(keys.select(*KEY).distinct().withColumn("__hit", F.lit(True)), KEY, "left")
    hit = F.coalesce("__hit", F.lit(False)) & (F.lit(True) if also is None else F.coalesce(also, F.lit(False)))
    marked = marked.withColumn("__hit", hit)
    for c in sorted(values, key=lambda c: c == "status"):  # the status last, as conditions read it
        marked = set_where(marked, F.col("__hit"), {c: values[c]})
    return marked.select(*stage_runs.columns)


def block_downstream(stage_runs: DataFrame, edges: DataFrame) -> DataFrame:
    """What follows from failed rows and hasn't begun is blocked."""
    return update_keys(stage_runs, below(stage_runs.where("status = 'failed'"), edges, False), {"status": "blocked"}, F.col("status").isin(*BLOCKABLE))


def reset_for_retry(stage_runs: DataFrame, rows: DataFrame, edges: DataFrame, active: Sequence[str], artifacts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(stage_runs, artifacts): the rows and what follows are reopened, active stages to pending and others to external, without artifacts."""
    keys = below(rows, edges, True)
    reopened = F.when(F.col("stage").isin(*active), "pending").otherwise("external")
    return update_keys(stage_runs, keys, cleared(reopened, error_tail=None, attempts=0, not_before=None)), runstate.missing(artifacts, keys, KEY)


def reopen(stage_runs: DataFrame, run: str, edges: DataFrame, active: Sequence[str], artifacts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All failed, canceled and blocked rows of a run, and what follows from them."""
    return reset_for_retry(stage_runs, of_run(stage_runs, run, status=REOPENED), edges, active, artifacts)


def force_rerun(stage_runs: DataFrame, artifacts: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(stage_runs, artifacts): the keys' rows are pending again, without artifacts."""
    return update_keys(stage_runs, keys, cleared("pending", error_tail=None, log_path=None, attempts=0, not_before=None)), runstate.missing(artifacts, keys, KEY)


def cancel(stage_runs: DataFrame, run: str, now: str) -> DataFrame:
    """Running rows end with code 143, other open ones are canceled."""
    here = F.col("run_id") == run
    ended = set_where(stage_runs, here & (F.col("status") == "running"), {"finished_at": now, "exit_code": 143, "error_tail": "Canceled by user", "native_id": None, "launch_token": None})
    return set_where(ended, here & F.col("status").isin("running", *OPEN), {"status": "canceled"})


def repair_orphans(stage_runs: DataFrame, run: str, active: Sequence[str], closure: Sequence[str]) -> DataFrame:
    """Pending rows of stages that the run only needs, and doesn't run, are external."""
    hit = (F.col("run_id") == run) & (F.col("status") == "pending") & F.col("stage").isin(*closure) & ~F.col("stage").isin(*active)
    return set_where(stage_runs, hit, {"status": "external"})


def skip_not_selected(stage_runs: DataFrame, run: str, active: Sequence[str], closure: Sequence[str], now: str) -> DataFrame:
    """Rows of stages outside the closure that haven't ended are skipped."""
    hit = (F.col("run_id") == run) & ~F.col("stage").isin(*active, *closure) & ~F.col("status").isin("skipped", "success", "failed")
    return set_where(set_where(stage_runs, hit, {"finished_at": now, "exit_code": 0}), hit, {"status": "skipped"})


def backfill(stage_runs: DataFrame, targets: DataFrame, run: str, stages: Sequence[str], active: Sequence[str]) -> DataFrame:
    """With the missing rows of all stages for every label of the run: pending if active, else external."""
    wanted = labels(stage_runs, targets, run).select(F.lit(run).alias("run_id"), "target_label", F.explode(F.array(*map(F.lit, stages))).alias("stage"))
    new = runstate.missing(wanted, stage_runs, KEY)
    return stage_runs.unionByName(new.withColumn("status", F.when(F.col("stage").isin(*active), "pending").otherwise("external")), allowMissingColumns=True)


def insert_once(df: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """INSERT OR IGNORE: rows of `new` (unique by key) whose key isn't there yet are added; `inserted` tells which."""
    added = runstate.missing(new, df, list(keys)).withColumn("inserted", F.lit(True))
    return df.withColumn("inserted", F.lit(False)).unionByName(added, allowMissingColumns=True)


def pending_commands(commands: DataFrame, limit: int = 50) -> DataFrame:
    return commands.where("processed_at is null").orderBy("id").limit(limit)


def final_status(stage_runs: DataFrame) -> DataFrame:
    """(run_id, status): running while anything is open, then failed, canceled or success."""
    n = lambda *s: F.count_if(F.col("status").isin(*s))
    status = F.when(n("running", *OPEN) > 0, "running").when(n("failed") > 0, "failed").when(n("canceled") > 0, "canceled").otherwise("success")
    return stage_runs.groupBy("run_id").agg(status.alias("status"))


def with_column(df: DataFrame, name: str, kind: str, default=None) -> DataFrame:
    """ALTER TABLE ADD COLUMN if it isn't there."""
    return df if name in df.columns else df.withColumn(name, F.lit(default).cast(kind))


#: Artifacts that remember why a stage was skipped, and reasons that aren't decided again.
SKIP_CACHE = ("external_check", "skip_reason")
SUPERSEDED = "superseded"
FINAL_REASONS = ("not_selected", SUPERSEDED, "stream_mode", "artifacts_verified")


def clear_skip_cache(artifacts: DataFrame, keys: DataFrame) -> DataFrame:
    """Without what is remembered about skipping the keys' stages; other artifacts stay."""
    cached = artifacts.where(F.col("artifact_type").isin(*SKIP_CACHE))
    return artifacts.where(~F.coalesce(F.col("artifact_type").isin(*SKIP_CACHE), F.lit(False))).unionByName(runstate.missing(cached, keys, KEY))


def enqueue_commands(commands: DataFrame, new: DataFrame, order: Sequence[str], now: str) -> DataFrame:
    """`commands` (id, run_id, kind, args_json, created_at, processed_at) with the rows of `new` (run_id, kind, args_json) after the last id.

    A batch of new commands is what people asked for since the last one, few rows.
    """
    last = commands.agg(F.coalesce(F.max("id"), F.lit(0)).alias("__last"))  # one row
    numbered = new.withColumn("__n", F.row_number().over(Window.orderBy(*order))).join(F.broadcast(last))
    rows = numbered.select((F.col("__last") + F.col("__n")).alias("id"), "run_id", "kind", F.coalesce("args_json", F.lit("{}")).alias("args_json"), F.lit(now).alias("created_at"))
    return commands.unionByName(rows, allowMissingColumns=True)


def mark_processed(commands: DataFrame, done: DataFrame, now: str) -> DataFrame:
    """The commands with the ids of `done` are processed now."""
    hit = commands.join(done.select("id").distinct().withColumn("__hit", F.lit(True)), "id", "left")
    return hit.withColumn("processed_at", F.when(F.col("__hit"), F.lit(now)).otherwise(F.col("processed_at"))).select(*commands.columns)


def set_daemon(daemon: DataFrame, pid: int, host: str, now: str) -> DataFrame:
    """The registry's one row, id 1, put in or replaced."""
    row = daemon.sparkSession.createDataFrame([(1, pid, host, now, now)], "id int, pid int, host string, started_at string, last_heartbeat string")
    return daemon.where("id != 1").unionByName(row, allowMissingColumns=True)


def set_force_launch(stage_runs: DataFrame, keys: DataFrame, enabled: bool) -> DataFrame:
    return update_keys(stage_runs, keys, {"force_launch": int(enabled)})


def age_seconds(iso: Column, now: Column) -> Column:
    """Seconds from an ISO 8601 time (UTC if it names no zone) to `now`, a timestamp; infinite for what isn't one."""
    then = F.when(iso.rlike(r"^\d{4}-\d{2}-\d{2}"), iso).try_cast("timestamp")
    return F.coalesce((F.unix_micros(now.cast("timestamp")) - F.unix_micros(then)) / 1e6, F.lit(float("inf")))


def with_verify_needed(stage_runs: DataFrame, edges: DataFrame, active: Sequence[str], closure: Sequence[str]) -> DataFrame:
    """Adds `verify_needed`: must the artifacts of a stage that the run only relies on be looked at?

    Not for active stages, those outside the closure or already satisfied, nor where a stage of the closure that directly follows is
    satisfied in the same target.
    """
    target = Window.partitionBy("run_id", "target_label")
    satisfied = F.collect_set(F.when(F.col("status").isin(*SATISFIED), F.col("stage"))).over(target)
    later = edges.toDF("__stage", "after").where(F.col("after").isin(*closure)).groupBy("__stage").agg(F.collect_set("after").alias("__later"))  # tens of rows
    joined = stage_runs.withColumn("__satisfied", satisfied).join(F.broadcast(later), F.col("stage") == F.col("__stage"), "left")
    open_stage = F.col("stage").isin(*closure) & ~F.col("stage").isin(*active) & ~F.coalesce(F.col("status").isin(*SATISFIED), F.lit(False))
    overtaken = F.coalesce(F.arrays_overlap("__later", "__satisfied"), F.lit(False))
    return joined.withColumn("verify_needed", open_stage & ~overtaken).drop("__stage", "__later", "__satisfied")


def skip_superseded(
    stage_runs: DataFrame, artifacts: DataFrame, edges: DataFrame, targets: DataFrame, run: str, active: Sequence[str], closure: Sequence[str], now: str
) -> tuple[DataFrame, DataFrame]:
    """(stage_runs, artifacts): stages of the closure that needn't be verified any more are skipped, with that as the remembered reason.

    Only for the run's targets (run_id, target_label, enabled) that aren't disabled; rows that ended in success or failure stay, as do those
    skipped for a reason that is final.
    """
    enabled = of_run(targets, run).where(F.coalesce(F.col("enabled") != 0, F.lit(True))).select("target_label").distinct().withColumn("__enabled", F.lit(True))
    reasons = artifacts.where("artifact_type = 'skip_reason'").groupBy(*KEY).agg(F.max("path").alias("__reason"))
    rows = with_verify_needed(of_run(stage_runs, run), edges, active, closure).join(enabled, "target_label").join(reasons, KEY, "left")
    final = (F.col("status") == "skipped") & F.coalesce(F.col("__reason").isin(*FINAL_REASONS), F.lit(False))
    hit = F.col("stage").isin(*closure) & ~F.col("stage").isin(*active) & ~F.col("verify_needed") & ~final & ~F.col("status").isin("success", "failed")
    keys = rows.where(hit).select(*KEY)
    remembered = keys.distinct().select(*KEY, F.lit("skip_reason").alias("artifact_type"), F.lit(SUPERSEDED).alias("path"), F.lit(now).alias("verified_at"))
    remembered = remembered.select(*(c for c in remembered.columns if c in artifacts.columns))
    kept = clear_skip_cache(artifacts, keys).unionByName(remembered, allowMissingColumns=True)
    return update_keys(stage_runs, keys, {"finished_at": now, "exit_code": 0, "status": "skipped"}), kept
