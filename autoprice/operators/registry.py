"""Run log and model versions as plain tables.

A tracking server keeps runs, versions, stages and aliases; here they are append-only tables and
the "current" state is a query over them (latest row per key), so history is never rewritten. The tables share one
numbered commit log (``sources.commit_log``): two writers at once get different versions, and what belongs together (a version,
its alias, its run) is appended together or not at all.
All aggregations are per model / version and algebraic (max, max_by), so a model with a huge
history is reduced map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autoprice.operators.ranking import global_index
from autoprice.sources.commit_log import CommitLog

# Stage -> alias mapping of the model registry.
STAGE_ALIAS = {"Production": "champion", "Staging": "challenger", "Archived": "archived"}


def run_log_rows(df: DataFrame, run_id, params: dict[str, str], metrics: dict[str, str], logged_at=None, model=None) -> DataFrame:
    """G1: long rows (model_name, run_id, kind, name, value, logged_at) for the given param / metric columns.
    ``logged_at`` is a timestamp column (default: the time of the query); without ``model``, a column, the rows name no model."""
    parts = [F.struct(F.lit("param").alias("kind"), F.lit(k).alias("name"), F.col(c).cast("string").alias("value"))
             for k, c in params.items()]
    parts += [F.struct(F.lit("metric").alias("kind"), F.lit(k).alias("name"), F.col(c).cast("string").alias("value"))
              for k, c in metrics.items()]
    at = F.current_timestamp() if logged_at is None else logged_at
    named = [] if model is None else [model.alias("model_name")]
    return df.select(*named, run_id.alias("run_id"), at.cast("timestamp").alias("logged_at"), F.explode(F.array(*parts)).alias("kv")) \
             .select(*["model_name"] * len(named), "run_id", "kv.*", "logged_at")


SCHEMAS = {
    "versions": "model_name string, version bigint, run_id string, description string, stage string, registered_at timestamp",
    "aliases": "model_name string, alias string, version bigint, set_at timestamp",
    "runs": "model_name string, run_id string, kind string, name string, value string, logged_at timestamp",
}


def registry_log(spark, path: str) -> CommitLog:
    """The registry's tables (versions, aliases, runs), all partitioned by model."""
    return CommitLog(spark, path, SCHEMAS, "model_name")


def log_run(rows: DataFrame, path: str) -> int:
    """G1 sink: append the rows of ``run_log_rows`` (with their model) to the registry's run log; earlier runs are never
    rewritten. Returns the commit's number."""
    rows = rows.checkpoint()  # the time of a query, and what a conflict would compute again
    return registry_log(rows.sparkSession, path).append(lambda _: {"runs": rows})


def runs(spark, path: str) -> DataFrame:
    return registry_log(spark, path).read("runs")


def numbered(rows: DataFrame, known: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (model_name, ...) with the next versions after those ``known``, in ``order`` within each model. No model's rows meet in one task."""
    last = known.groupBy("model_name").agg(F.max("version").alias("_last"))
    idx = global_index(rows, ["model_name", *order], "_i")
    first = idx.groupBy("model_name").agg(F.min("_i").alias("_first"))
    start = first.join(last, "model_name", "left").select(F.col("model_name").alias("_m"), (F.coalesce("_last", F.lit(0)) + 1 - F.col("_first")).alias("_add"))
    return idx.join(start, F.col("model_name") == F.col("_m")).withColumn("version", F.col("_i") + F.col("_add")).drop("_i", "_add", "_m")


def register_versions(spark, path: str, rows: DataFrame, order: list[str] | None = None, at: str | None = None) -> int:
    """G2 for many at once: ``rows`` (model_name, run_id, description, stage) become each model's next versions, in
    ``order`` (by default run_id), in one commit. Returns its number."""
    log = registry_log(spark, path)
    when = F.lit(at).cast("timestamp") if at else F.current_timestamp()
    return log.append(lambda s: {"versions": numbered(rows, log.read("versions", s), order or ["run_id"]).withColumn("registered_at", when)})


def register_version(spark, path: str, model: str, run_id: str, description: str = "", stage: str = "None",
                     at: str | None = None, alias: str | None = None, run: DataFrame | None = None) -> int:
    """Append the next version of ``model`` with its run and description; returns its number, which no other
    writer gets. ``alias`` points that alias at it, and ``run`` adds rows of ``run_log_rows``, in the same commit."""
    log, given = registry_log(spark, path), {}
    when = F.lit(at).cast("timestamp") if at else F.current_timestamp()

    def build(state) -> dict[str, DataFrame]:
        known = log.read("versions", state).where(F.col("model_name") == model)
        given["version"] = version = int(known.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]) + 1
        one = spark.range(1).select(F.lit(model).alias("model_name"), F.lit(version).alias("version"), F.lit(run_id).alias("run_id"),
                                    F.lit(description).alias("description"), F.lit(stage).alias("stage"), when.alias("registered_at"))
        adds = {"versions": one}
        if alias:
            adds["aliases"] = one.select("model_name", F.lit(alias).alias("alias"), "version", when.alias("set_at"))
        if run is not None:
            adds["runs"] = run
        return adds
    log.append(build)
    return given["version"]


def set_aliases(spark, path: str, events: DataFrame, at: str | None = None) -> int:
    """G4 for many at once: append ``events`` (model_name, alias, version) in one commit; returns its number."""
    when = F.lit(at).cast("timestamp") if at else F.current_timestamp()
    return registry_log(spark, path).append(lambda _: {"aliases": events.withColumn("set_at", when)})


def set_alias(spark, path: str, model: str, alias: str, version: int, at: str | None = None) -> None:
    """Append an alias event; the latest event of (model, alias) holds. A version that is not registered raises KeyError."""
    log = registry_log(spark, path)
    when = F.lit(at).cast("timestamp") if at else F.current_timestamp()

    def build(state) -> dict[str, DataFrame]:
        if log.read("versions", state).where((F.col("model_name") == model) & (F.col("version") == version)).isEmpty():
            raise KeyError(f"model {model} has no version {version}")
        return {"aliases": spark.range(1).select(F.lit(model).alias("model_name"), F.lit(alias).alias("alias"),
                                                 F.lit(version).alias("version"), when.alias("set_at"))}
    log.append(build)


def alias_events(spark, path: str) -> DataFrame:
    return registry_log(spark, path).read("aliases")


def versions(spark, path: str) -> DataFrame:
    """The versions with their current stage: the champion's latest event makes it Production, and
    versions that held it before are Archived (G5); others keep the stage they were registered with."""
    log = registry_log(spark, path)
    state = log.state()  # one state for both tables
    v = log.read("versions", state)
    held = log.read("aliases", state).where("alias = 'champion'")
    now = held.groupBy("model_name").agg(F.max_by("version", F.struct("set_at", "version")).alias("_now"))
    once = held.select("model_name", "version", F.lit(True).alias("_once")).distinct()
    d = v.join(now, "model_name", "left").join(once, ["model_name", "version"], "left")
    stage = F.when(F.col("version") == F.col("_now"), "Production").when(F.col("_once"), "Archived").otherwise(F.col("stage"))
    return d.withColumn("stage", stage).select(v.columns)


def next_versions(versions: DataFrame, model: str = "model_name", version: str = "version") -> DataFrame:
    """The next integer version per model (1 for a model without versions)."""
    return versions.groupBy(model).agg((F.coalesce(F.max(version), F.lit(0)) + 1).alias("next_version"))


def latest_versions(versions: DataFrame, model: str = "model_name", version: str = "version") -> DataFrame:
    """The highest version per model with its attributes."""
    others = [c for c in versions.columns if c not in (model, version)]
    best = versions.groupBy(model).agg(F.max_by(F.struct(version, *others), F.col(version)).alias("b"))
    return best.select(model, "b.*")


def stage_alias(stage) -> F.Column:
    """Stage -> alias: Production/Staging/Archived -> champion/challenger/archived, else lower-case."""
    expr = F.lower(stage)
    for s, a in reversed(list(STAGE_ALIAS.items())):
        expr = F.when(stage == s, F.lit(a)).otherwise(expr)
    return expr


def resolve_alias(versions: DataFrame, events: DataFrame, alias: str, tag_stage: str | None = None,
                  model: str = "model_name", version: str = "version", stage: str = "stage") -> DataFrame:
    """Per model, the version of the latest event of ``alias`` (``events``: model, alias, version,
    set_at); without one, the latest version whose stage tag is ``tag_stage``; else NULL."""
    latest = (events.where(F.col("alias") == alias).groupBy(F.col(model).alias("_m"))
              .agg(F.max_by(version, F.struct("set_at", version)).alias("_v")))
    by_tag = F.max(F.when(F.col(stage) == tag_stage, F.col(version))) if tag_stage else F.lit(None).cast("bigint")
    tagged = versions.groupBy(model).agg(by_tag.alias("_tag"))
    return tagged.join(latest, F.col(model) == F.col("_m"), "left").select(
        model, F.lit(alias).alias("alias"), F.coalesce("_v", "_tag").alias("resolved_version"))


def promote(versions: DataFrame, winners: DataFrame, model: str = "model_name", version: str = "version",
            stage: str = "stage") -> DataFrame:
    """The winner of each model becomes Production (champion); other Production versions of that
    model become Archived; everything else keeps its stage. ``winners`` has (model, version).

    ``winners`` holds one row per model, so the join is keyed by model (skew-free: a model with
    many versions meets exactly one winner row).
    """
    w = winners.select(F.col(model).alias("_wm"), F.col(version).alias("_wv"))
    j = versions.join(w, versions[model] == w["_wm"], "left")
    new_stage = (F.when(F.col(version) == F.col("_wv"), F.lit("Production"))
                  .when(F.col("_wv").isNotNull() & (F.col(stage) == "Production"), F.lit("Archived"))
                  .otherwise(F.col(stage)))
    return j.select(model, version, F.col(stage).alias("old_stage"), new_stage.alias("stage"),
                    stage_alias(new_stage).alias("alias"))


def compare_runs(run_log: DataFrame, metrics: list[str]) -> DataFrame:
    """One row per run, one column per metric (pivot with an explicit value list); of a metric that
    was logged more than once, the latest value holds."""
    m = run_log.where(F.col("kind") == "metric")
    return m.groupBy("run_id").pivot("name", metrics).agg(
        F.max_by(F.col("value").cast("double"), F.struct("logged_at", F.col("value").cast("double"))))
