"""Bootstrap, t-test, decisions and validation ladders.

Bootstrap metrics depend on the resample only through the confusion counts, so two forms exist:

* ``bootstrap_confusion_poisson``: every row gets a Poisson(1) weight per iteration from md5 of
  (key, block of four iterations, seed); weighted counts per iteration come from one aggregate (the generated
  iteration rows never leave the task: partial aggregation folds them to B rows per task). It is
  reproducible in any engine, which is why the SQL oracle can check it.
* ``bootstrap_confusion_multinomial``: the data is aggregated once to the <= 2^(1+m) cells of
  (y, yhat_1..yhat_m); each iteration then draws one multinomial of size n over those cells --
  exactly the distribution of resampling n rows with replacement, at a cost independent of n.
  This is the form the A/B job uses at scale.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autoprice.functions.scalar import DRAWS_PER_HASH, poisson1, uniforms
from autoprice.functions.stats import p_value
from autoprice.operators.metrics import classification_from_counts

# Validation statuses and quality grades of the training / validation workflow.
STATUS_IMPROVED = "PASSED - Significant improvement"
STATUS_NO_DEGRADATION = "PASSED - No significant degradation"
STATUS_DEGRADED = "FAILED - Significant degradation"
STATUS_SKIPPED = "SKIPPED - Not enough data"
STATUS_SKIPPED_SPLIT = "SKIPPED - Not enough data after split"
GRADE_EXCELLENT, GRADE_GOOD, GRADE_SATISFACTORY, GRADE_LOW = "EXCELLENT", "GOOD", "SATISFACTORY", "LOW"
SUFFIX_FAILED, SUFFIX_SKIPPED = " + VALIDATION FAILED", " + VALIDATION SKIPPED"
DECISION_DEPLOY = "deploy"
DECISION_KEEP = "keep"
REASON_SIGNIFICANT = "candidate shows a statistically significant improvement"
REASON_NO_IMPROVEMENT = "candidate shows no improvement"
REASON_NOT_SIGNIFICANT = "improvement is not statistically significant"


def _long_models(wide: DataFrame, models: list[str], id_col: str = "iteration") -> DataFrame:
    """One row per (iteration, model) from the wide per-iteration counts, in a single pass."""
    cells = F.array(*[F.struct(F.lit(m).alias("model"), *[F.col(f"{m}_{c}").alias(c) for c in ("tp", "fp", "fn", "tn")])
                      for m in models])
    out = wide.select(id_col, F.explode(cells).alias("m")).select(id_col, "m.*")
    return out.select(id_col, "model", "tp", "fp", "fn", "tn", *classification_from_counts())


def bootstrap_confusion_poisson(df: DataFrame, key: str, y: str, preds: dict[str, str], iterations: int = 100,
                                seed: int = 42) -> DataFrame:
    """B1 / B2 (paired): per (iteration, model) weighted confusion counts and metrics.

    The same weight multiplies every model's row, so the resamples are paired by construction.
    """
    blocks = -(-iterations // DRAWS_PER_HASH)
    d = df.select(key, y, *preds.values(), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block"))
    # one hash per row and block of four iterations; the weights are columns, so the block is one row
    d = d.select("*", *[poisson1(u).alias(f"_w{k}") for k, u in enumerate(uniforms(key, "block", seed))])
    cells = (("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0), ("tn", 0, 0))
    aggs = [F.sum(F.when((F.col(y) == a) & (F.col(c) == b), F.col(f"_w{k}")).otherwise(0)).cast("bigint").alias(f"{m}_{name}_{k}")
            for k in range(DRAWS_PER_HASH) for m, c in preds.items() for name, a, b in cells]
    names = [f"{m}_{name}" for m in preds for name, _, _ in cells]
    four = F.array(*[F.struct((F.col("block") * DRAWS_PER_HASH + k).alias("iteration"), *[F.col(f"{n}_{k}").alias(n) for n in names])
                     for k in range(DRAWS_PER_HASH)])
    wide = d.groupBy("block").agg(*aggs).select(F.inline(four)).where(F.col("iteration") < iterations)
    return _long_models(wide, list(preds))


def confusion_cells(df: DataFrame, y: str, preds: dict[str, str]) -> DataFrame:
    """Counts of the (y, yhat_1, ..., yhat_m) cells: at most 2^(1+m) rows."""
    return df.groupBy(y, *preds.values()).agg(F.count(F.lit(1)).alias("cnt"))


def bootstrap_confusion_multinomial(df: DataFrame, y: str, preds: dict[str, str], iterations: int = 100,
                                    seed: int = 42) -> DataFrame:
    """B1 / B2 at scale: one multinomial(n, cell shares) draw per iteration (numpy, seeded by
    ``seed + iteration``), distributed over iterations; the data is read once."""
    cols = [y, *preds.values()]
    cells = confusion_cells(df, y, preds)
    packed = cells.agg(F.collect_list(F.struct(*[F.col(c).cast("int").alias(c) for c in cols], "cnt")).alias("cells"))
    models = list(preds.items())
    schema = "iteration long, model string, tp long, fp long, fn long, tn long"

    def draw(batches):
        for pdf in batches:
            out = []
            for it, cell_list in zip(pdf["iteration"], pdf["cells"]):
                cl = [c for c in cell_list if all(c[k] is not None for k in cols)]
                counts = np.array([c["cnt"] for c in cl], dtype="int64")
                n = int(counts.sum())
                rng = np.random.default_rng(int(seed) + int(it))
                k = rng.multinomial(n, counts / n) if n else counts
                for m, pc in models:
                    tp = fp = fn = tn = 0
                    for c, kk in zip(cl, k):
                        yy, pp = c[y], c[pc]
                        tp += kk * (yy == 1 and pp == 1)
                        fp += kk * (yy == 0 and pp == 1)
                        fn += kk * (yy == 1 and pp == 0)
                        tn += kk * (yy == 0 and pp == 0)
                    out.append((int(it), m, int(tp), int(fp), int(fn), int(tn)))
            yield pd.DataFrame(out, columns=["iteration", "model", "tp", "fp", "fn", "tn"])

    spark = df.sparkSession
    its = spark.range(iterations).withColumnRenamed("id", "iteration") \
               .withColumn("cells", packed.scalar())
    counts = its.mapInPandas(draw, schema)
    return counts.select("iteration", "model", "tp", "fp", "fn", "tn", *classification_from_counts())


def t_test(scores: DataFrame, base: str, candidate: str, metrics: list[str] = ("f1", "precision"),
           alpha: float = 0.01, with_p: bool = True) -> DataFrame:
    """B3 + B4: equal-variance two-sample t-test of base vs candidate per metric.

    ``scores`` is long: (model, <metric columns>) one row per bootstrap iteration. t is computed as
    base minus candidate (scipy's ``ttest_ind(base, candidate)``); effect size is
    ``|mean_c - mean_b| / sqrt((var_b + var_c) / 2)`` with sample variances.
    """
    long = scores.where(F.col("model").isin(base, candidate)) \
                 .unpivot(["model"], list(metrics), "metric", "value")
    s = long.groupBy("metric").agg(
        F.count(F.when(F.col("model") == base, 1)).alias("n_b"),
        F.count(F.when(F.col("model") == candidate, 1)).alias("n_c"),
        F.avg(F.when(F.col("model") == base, F.col("value"))).alias("base_mean"),
        F.avg(F.when(F.col("model") == candidate, F.col("value"))).alias("candidate_mean"),
        F.var_samp(F.when(F.col("model") == base, F.col("value"))).alias("var_b"),
        F.var_samp(F.when(F.col("model") == candidate, F.col("value"))).alias("var_c"))
    dfree = F.col("n_b") + F.col("n_c") - 2
    sp2 = F.try_divide((F.col("n_b") - 1) * F.col("var_b") + (F.col("n_c") - 1) * F.col("var_c"), dfree)
    se = F.sqrt(sp2 * (F.lit(1.0) / F.col("n_b") + F.lit(1.0) / F.col("n_c")))
    t = F.try_divide(F.col("base_mean") - F.col("candidate_mean"), se)
    eff = F.try_divide(F.abs(F.col("candidate_mean") - F.col("base_mean")),
                       F.sqrt((F.col("var_b") + F.col("var_c")) / 2))
    out = s.select("metric", t.alias("t_statistic"), dfree.alias("dof"), eff.alias("effect_size"),
                   "base_mean", "candidate_mean", (F.col("candidate_mean") - F.col("base_mean")).alias("improvement"))
    if with_p:
        out = out.withColumn("p_value", p_value(F.col("t_statistic"), F.col("dof"))) \
                 .withColumn("is_significant", F.coalesce(F.col("p_value") < alpha, F.lit(False)))
    return out


def deploy_decision(comparison: DataFrame, metric: str = "f1", significant: str = "is_significant") -> DataFrame:
    """Deploy iff the F1 difference is significant and the candidate improves F1."""
    r = comparison.where(F.col("metric") == metric)
    sig, imp = F.col(significant), F.col("improvement") > 0
    return r.select(
        F.col(significant).alias("f1_significant"), imp.alias("f1_improved"),
        F.when(sig & imp, DECISION_DEPLOY).otherwise(DECISION_KEEP).alias("decision"),
        F.when(sig & imp, REASON_SIGNIFICANT).when(~imp, REASON_NO_IMPROVEMENT)
         .otherwise(REASON_NOT_SIGNIFICANT).alias("reason"))


def improvement_pct(r2_a, r2_b):
    """``(r2_b - r2_a) / r2_a * 100``, 0 when r2_a is 0; the sign flips when r2_a < 0."""
    return F.when(r2_a == 0, F.lit(0.0)).otherwise((r2_b - r2_a) / r2_a * 100)


def validation_status(improvement):
    """Status text and the logged numeric code."""
    text = (F.when(improvement > 5, STATUS_IMPROVED).when(improvement > -5, STATUS_NO_DEGRADATION)
             .otherwise(STATUS_DEGRADED))
    code = F.when(improvement > -5, F.lit(1)).otherwise(F.lit(0))
    return text, code


LEAST_ROWS, LEAST_SIDE = 6, 2


def validation_skip(n_total, n_old, n_new):
    """SKIPPED when fewer than 6 rows, or fewer than 2 rows on a side after the split."""
    return (F.when(n_total < LEAST_ROWS, STATUS_SKIPPED)
             .when((n_new < LEAST_SIDE) | (n_old < LEAST_SIDE), STATUS_SKIPPED_SPLIT))


def validated(row: DataFrame) -> DataFrame:
    """B7-B9 on a row with r2_a, r2_b, n_old and n_new: improvement_pct, validation_status and
    validation_code. A skipped validation has improvement 0 and code 0."""
    skip = validation_skip(F.col("n_old") + F.col("n_new"), F.col("n_old"), F.col("n_new"))
    row = row.withColumn("_skip", skip).withColumn(
        "improvement_pct", F.when(F.col("_skip").isNotNull(), F.lit(0.0)).otherwise(improvement_pct(F.col("r2_a"), F.col("r2_b"))))
    text, code = validation_status(F.col("improvement_pct"))
    return (row.withColumn("validation_status", F.coalesce("_skip", text))
            .withColumn("validation_code", F.when(F.col("_skip").isNotNull(), F.lit(0)).otherwise(code)).drop("_skip"))


def quality_grade(r2, cv_r2, status):
    """Grade from test R^2 and CV R^2 (NULL never satisfies a test) plus a validation suffix."""
    r2_ok = lambda v: F.coalesce(r2 > v, F.lit(False))
    cv_ok = lambda v: F.coalesce(cv_r2 > v, F.lit(False))
    grade = (F.when(r2_ok(0.8) & cv_ok(0.7), GRADE_EXCELLENT).when(r2_ok(0.6) & cv_ok(0.5), GRADE_GOOD)
              .when(r2_ok(0.4), GRADE_SATISFACTORY).otherwise(GRADE_LOW))
    suffix = (F.when(status.contains("FAILED"), SUFFIX_FAILED).when(status.contains("SKIPPED"), SUFFIX_SKIPPED)
               .otherwise(""))
    return F.concat(grade, suffix)


def final_summary(row: DataFrame, run_id: str, r2: str = "r2", cv_r2: str = "cv_r2",
                  status: str = "validation_status", quality: str = "quality") -> DataFrame:
    """One summary row; R^2 printed with 4 decimals, ``N/A`` when missing."""
    from autoprice.functions.scalar import fixed_decimals
    r2s = F.coalesce(fixed_decimals(r2, 4), F.lit("N/A"))
    return row.select(F.concat(F.col(quality), F.lit(" - R2: "), r2s).alias("status"), F.lit(run_id).alias("run_id"),
                      F.col(r2).alias("r2_score"), F.col(cv_r2).alias("cv_r2_score"),
                      F.col(status).alias("validation_status"), F.col(quality).alias("quality"))
