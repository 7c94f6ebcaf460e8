"""Catalogue entries: run log and model versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from autoprice.operators import registry as RG
from autoprice.plans.fixtures import view, with_views
from autoprice.plans.registry import register
from autoprice.session import scratch_dir

_ALIAS_SQL = ("case when stage = 'Production' then 'champion' when stage = 'Staging' then 'challenger' "
              "when stage = 'Archived' then 'archived' else lower(stage) end")


def _run_log(spark, sf_dir):
    """Two appends to the run log, partitioned by model: every run, then the runs of even versions again, an hour later and
    with r2 raised by one; read back as one table."""
    mv = view(spark, sf_dir, "model_versions")
    run_id = F.concat_ws("-", "model_name", F.col("version").cast("string"))
    path = scratch_dir(spark, "run-log")

    def rows(d, at):
        d = d.withColumn("r2_txt", F.format_string("%.6f", "r2")).withColumn("r2_pct_txt", F.format_string("%.6f", F.col("r2") * 100))
        return RG.run_log_rows(d, run_id, {"stage": "stage"}, {"r2": "r2_txt", "r2_pct": "r2_pct_txt"}, F.lit(at), F.col("model_name"))

    RG.log_run(rows(mv, "2024-01-01 00:00:00"), path)
    RG.log_run(rows(mv.where("version % 2 = 0").withColumn("r2", F.col("r2") + 1), "2024-01-01 01:00:00"), path)
    return RG.runs(spark, path)


_LOG_SQL = """
, src as (select *, '2024-01-01 00:00:00' as logged_at from model_versions
  union all select * replace (r2 + 1 as r2), '2024-01-01 01:00:00' from model_versions where version % 2 = 0),
lg as (select model_name, model_name || '-' || cast(version as varchar) as run_id, 'param' as kind, 'stage' as name, stage as value, logged_at from src
  union all select model_name, model_name || '-' || cast(version as varchar), 'metric', 'r2', printf('%.6f', r2), logged_at from src
  union all select model_name, model_name || '-' || cast(version as varchar), 'metric', 'r2_pct', printf('%.6f', r2 * 100), logged_at from src)"""


@register("log_run", with_views(_LOG_SQL + "\nselect model_name, run_id, kind, name, value, logged_at from lg", "model_versions"))
def q_log_run(spark, sf_dir):
    return _run_log(spark, sf_dir).withColumn("logged_at", F.date_format("logged_at", "yyyy-MM-dd HH:mm:ss"))


@register("register_version", with_views(
    "select model_name, coalesce(max(version), 0) + 1 as next_version from model_versions group by model_name",
    "model_versions"))
def q_register_version(spark, sf_dir):
    return RG.next_versions(view(spark, sf_dir, "model_versions"))


@register("registry_versions", with_views("""
, b as (select model_name, version as key, r2, case when version % 2 = 0 then 1 else 2 end as batch from model_versions),
v as (select *, row_number() over (partition by model_name order by batch, key) as version from b),
w as (select model_name, max(version) as last, max_by(version, (r2, version)) as best from v group by model_name)
select v.model_name, version, 'run-' || cast(key as varchar) as run_id,
  case when version = last then 'Production' when version = best then 'Archived' else 'None' end as stage
from v join w on v.model_name = w.model_name""", "model_versions"))
def q_registry_versions(spark, sf_dir):
    """Four commits: half of the runs become versions, then the other half; the best version of each model becomes champion,
    then the last one; the tables are compacted, and the registry's versions are read with their stages."""
    mv = view(spark, sf_dir, "model_versions").select("model_name", F.col("version").alias("key"), "r2")
    path = scratch_dir(spark, "registry")
    rows = mv.select("model_name", "key", F.concat(F.lit("run-"), F.col("key").cast("string")).alias("run_id"),
                     F.lit("").alias("description"), F.lit("None").alias("stage"))
    RG.register_versions(spark, path, rows.where("key % 2 = 0"), ["key"], "2024-01-01")
    RG.register_versions(spark, path, rows.where("key % 2 <> 0"), ["key"], "2024-01-02")
    known = RG.versions(spark, path).join(rows.select("model_name", "run_id", "key"), ["model_name", "run_id"]).join(mv, ["model_name", "key"])
    champion = lambda d: d.select("model_name", F.lit("champion").alias("alias"), "version")
    RG.set_aliases(spark, path, champion(known.groupBy("model_name").agg(F.max_by("version", F.struct("r2", "version")).alias("version"))), "2024-01-03")
    RG.set_aliases(spark, path, champion(RG.latest_versions(RG.versions(spark, path))), "2024-01-04")
    RG.registry_log(spark, path).compact()
    return RG.versions(spark, path).select("model_name", "version", "run_id", "stage")


@register("latest_version", with_views(
    "select model_name, max(version) as version, max_by(r2, version) as r2, max_by(stage, version) as stage "
    "from model_versions group by model_name", "model_versions"))
def q_latest_version(spark, sf_dir):
    return RG.latest_versions(view(spark, sf_dir, "model_versions"))


# Alias events: model m1 never had a champion, and challengers come and go.
_EVENTS = """select model_name, case when version % 3 = 0 then 'champion' else 'challenger' end as alias, version,
  version * 7919 % 101 as set_at from model_versions where (version % 3 = 0 and model_name <> 'm1') or version % 5 = 1"""


@register("resolve_alias", with_views(f"""
, ev as ({_EVENTS}),
names as (select * from (values ('champion', 'Production'), ('challenger', 'Staging'), ('shadow', 'Archived')) t(alias, tag)),
tagged as (select model_name, n.alias, max(version) filter (where stage = n.tag) as v from model_versions, names n group by all),
latest as (select model_name, alias, max_by(version, (set_at, version)) as v from ev group by all)
select t.model_name, t.alias, coalesce(l.v, t.v) as resolved_version
from tagged t left join latest l on t.model_name = l.model_name and t.alias = l.alias""", "model_versions"))
def q_resolve_alias(spark, sf_dir):
    mv = view(spark, sf_dir, "model_versions")
    events = spark.sql(_EVENTS)
    out = [RG.resolve_alias(mv, events, a, t) for a, t in (("champion", "Production"), ("challenger", "Staging"), ("shadow", "Archived"))]
    return out[0].unionByName(out[1]).unionByName(out[2])


@register("promote", with_views(f"""
, w as (select model_name as wm, max_by(version, (r2, version)) as wv from model_versions group by model_name),
j as (select model_name, version, stage as old_stage,
  case when version = wv then 'Production' when wv is not null and stage = 'Production' then 'Archived' else stage end as stage
  from model_versions left join w on model_name = wm)
select model_name, version, old_stage, stage, {_ALIAS_SQL} as alias from j""", "model_versions"))
def q_promote(spark, sf_dir):
    mv = view(spark, sf_dir, "model_versions")
    winners = mv.groupBy("model_name").agg(F.max_by("version", F.struct("r2", "version")).alias("version"))
    return RG.promote(mv, winners)


@register("compare_runs", with_views(_LOG_SQL + """
select run_id, max_by(cast(value as double), logged_at) filter (where name = 'r2') as r2,
  max_by(cast(value as double), logged_at) filter (where name = 'r2_pct') as r2_pct
from lg where kind = 'metric' group by run_id""", "model_versions"))
def q_compare_runs(spark, sf_dir):
    return RG.compare_runs(_run_log(spark, sf_dir), ["r2", "r2_pct"])
