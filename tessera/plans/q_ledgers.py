"""Ledger queries: run history, promotion ledger, registry and experiments
(W2-W6, N2, N3, N5, N7, A15, J6, J7, T3, T5, F10, O4-O6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import DEFAULT
from ..operators import metrics as M
from ..operators import registry as RG
from ..operators import runs as RN
from ..sources import views as V
from .catalog import register
from .oracle_views import V_MODEL_VERSIONS, V_RUN_EVENTS, V_RUNS, with_views

CFG = DEFAULT

_RUNS_SQL = with_views(V_RUN_EVENTS) + """, e AS (
  SELECT *, coalesce(sum(CASE WHEN kind <> 'start' THEN 1 ELSE 0 END) OVER (
           PARTITION BY dag_id, run_id ORDER BY evt_at, event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg
  FROM run_events),
st AS (SELECT dag_id, run_id, seg, event_id AS s_id, evt_at AS s_at,
              row_number() OVER (PARTITION BY dag_id, run_id, seg ORDER BY evt_at DESC, event_id DESC) AS rn
       FROM e WHERE kind = 'start'),
fi AS (SELECT dag_id, run_id, seg, event_id AS f_id, evt_at AS f_at, kind, metrics FROM e WHERE kind <> 'start'),
sg AS (SELECT coalesce(s.dag_id, f.dag_id) AS dag_id, coalesce(s.run_id, f.run_id) AS run_id,
              s.s_id, s.s_at, f.f_id, f.f_at, f.kind, f.metrics
       FROM (SELECT * FROM st WHERE rn = 1) s
       FULL OUTER JOIN fi f ON s.dag_id = f.dag_id AND s.run_id = f.run_id AND s.seg = f.seg),
runs AS (
SELECT sha256(dag_id || ':' || run_id || ':' || CAST(coalesce(s_id, f_id) AS VARCHAR)) AS id,
       dag_id, run_id,
       CASE WHEN f_id IS NULL THEN 'running' ELSE kind END AS status,
       coalesce(s_at, f_at) AS started_at,
       f_at AS completed_at,
       CASE WHEN f_id IS NULL THEN NULL WHEN s_id IS NULL THEN 0
            ELSE greatest(0, CAST(round((epoch_us(f_at) - epoch_us(s_at)) / 1000000.0) AS BIGINT)) END
         AS duration_seconds,
       CASE WHEN f_id IS NULL THEN NULL ELSE coalesce(metrics, '{}') END AS metrics
FROM sg)
"""
_RUN_SPEC = ("id:str dag_id:str run_id:str status:str started_at:ts completed_at:ts "
             "duration_seconds:int metrics:str")


def run_history_df(t):
    return RN.fold_runs(V.run_events(t))


@register("run_history", _RUNS_SQL + "SELECT * FROM runs", _RUN_SPEC)
def run_history(t):
    """Pipeline run rows folded from append-only run events."""
    return run_history_df(t)


@register("recent_runs", _RUNS_SQL + "SELECT * FROM runs ORDER BY started_at DESC, id DESC LIMIT 50",
          _RUN_SPEC)
def recent_runs(t):
    """The 50 newest run rows by start."""
    return M.recent_runs(run_history_df(t), 50)


@register("run_summary", _RUNS_SQL + """
SELECT dag_id, count(*) AS runs, sum(CASE WHEN status = 'success' THEN 1 ELSE 0 END) AS succeeded,
       sum(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS failed,
       sum(CASE WHEN status = 'running' THEN 1 ELSE 0 END) AS running,
       max(started_at) AS last_started_at, avg(duration_seconds) AS mean_duration_seconds
FROM runs GROUP BY dag_id""",
          "dag_id:str runs:int succeeded:int failed:int running:int last_started_at:ts "
          "mean_duration_seconds:dbl")
def run_summary(t):
    """Per-DAG run summary."""
    return RN.run_summary(run_history_df(t))


_LEDGER_SQL = with_views(V_RUNS, V_MODEL_VERSIONS) + """, l AS (
  SELECT *, max(CASE WHEN has_metrics THEN coalesce(f1_macro, 0) END) OVER (
           PARTITION BY name ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prod
  FROM model_versions),
p AS (SELECT *, prod IS NULL OR coalesce(f1_macro, 0) > prod AS promoted FROM l),
lp AS (SELECT name, max(version) AS last_prod FROM p WHERE promoted GROUP BY name),
ledger AS (
  SELECT p.name, p.version, p.position, p.run_id, p.registered_at, p.f1_macro, p.accuracy, p.promoted,
         coalesce(p.prod, 0) AS old_f1, coalesce(p.f1_macro, 0) AS new_f1,
         CASE WHEN p.promoted THEN 'Production' ELSE 'Staging' END AS decision_stage,
         CASE WHEN p.version = lp.last_prod THEN 'Production' WHEN p.promoted THEN 'Archived'
              ELSE 'Staging' END AS stage
  FROM p LEFT JOIN lp ON p.name = lp.name)
"""


def ledger_df(t):
    """The version table (one row per version) is read by every step of the
    ledger (rank offsets, running max, last promotion, deployments)."""
    return RG.promotion_ledger(V.model_versions(t, CFG))


@register("promotion_ledger", _LEDGER_SQL + """
SELECT name, version, run_id, promoted, old_f1, new_f1, decision_stage, stage FROM ledger""",
          "name:str version:int run_id:str promoted:bool old_f1:dbl new_f1:dbl decision_stage:str stage:str")
def promotion_ledger(t):
    """F1-gated promotion decision and final stage of every version."""
    return ledger_df(t).select("name", "version", "run_id", "promoted", "old_f1", "new_f1",
                               "decision_stage", "stage")


@register("current_versions", _LEDGER_SQL + """
SELECT name, stage, max(version) AS version, arg_max(run_id, version) AS run_id FROM ledger GROUP BY ALL""",
          "name:str stage:str version:int run_id:str")
def current_versions(t):
    """Newest version per (model, stage)."""
    return RG.current_versions(ledger_df(t))


@register("deployment_history", _LEDGER_SQL + """
SELECT name AS model_name, version AS model_version, run_id, new_f1 AS f1_score, accuracy,
       registered_at AS deployed_at,
       lead(registered_at) OVER (PARTITION BY name ORDER BY version) AS replaced_at,
       lead(registered_at) OVER (PARTITION BY name ORDER BY version) IS NULL AS is_active
FROM ledger WHERE promoted""",
          "model_name:str model_version:int run_id:str f1_score:dbl accuracy:dbl deployed_at:ts "
          "replaced_at:ts is_active:bool")
def deployment_history(t):
    """Deployments of promoted versions (replaced_at = next promotion)."""
    return RG.deployment_history(ledger_df(t))


@register("registry_listing", _LEDGER_SQL + """
SELECT l.name, l.version, l.stage, l.run_id,
       CASE WHEN l.position % 5 = 0 THEN l.f1_macro ELSE l.f1_macro / 2 END AS f1_macro,
       CASE WHEN l.position % 5 = 0 THEN l.accuracy ELSE l.accuracy / 4 END AS accuracy
FROM ledger l JOIN (SELECT DISTINCT experiment AS name FROM runs) m ON l.name = m.name""",
          "name:str version:int stage:str run_id:str f1_macro:dbl accuracy:dbl")
def registry_listing(t):
    """Registered models with their versions, stage and metrics
    (tags, falling back to the run's metrics)."""
    led = ledger_df(t)
    vm = RG.version_metrics(led, V.runs(t))
    models = V.runs(t).select(F.col("experiment").alias("name")).distinct()
    j = vm.join(models, "name")
    return j.select("name", "version", "stage", "run_id",
                    F.col("metrics")["f1_macro"].alias("f1_macro"),
                    F.col("metrics")["accuracy"].alias("accuracy"))


_EXP_SQL = with_views(V_RUNS) + """, top AS (
  SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY start_time DESC, run_id) AS rn FROM runs)
SELECT run_id, coalesce(run_name_tag, substr(run_id, 1, 8)) AS run_name, experiment, status, start_time,
       coalesce(f1_macro, 0) AS f1, coalesce(accuracy, 0) AS accuracy, 0.0 AS precision, 0.0 AS recall,
       0.0 AS latency, 0.0 AS duration
FROM top WHERE rn <= 50"""
_EXP_SPEC = ("run_id:str run_name:str experiment:str status:str start_time:ts f1:dbl accuracy:dbl "
             "precision:dbl recall:dbl latency:dbl duration:dbl")


@register("experiment_runs", _EXP_SQL, _EXP_SPEC)
def experiment_runs(t):
    """Newest 50 runs per experiment with metric defaults."""
    exps = V.runs(t).select("experiment").distinct()
    return RG.experiment_runs(V.runs(t), exps, CFG.runs_per_experiment)


@register("leaderboard", _EXP_SQL + "", _EXP_SPEC)
def leaderboard(t):
    """T5: every listed run by F1 (descending), ties by run id."""
    rows = RG.experiment_runs(V.runs(t), None, CFG.runs_per_experiment)
    return RG.leaderboard(rows, "f1")


@register("best_candidate", with_views(V_RUNS) + """
SELECT experiment,
       arg_max(run_id, (f1_macro, -position)) AS winner_run_id,
       max(f1_macro) AS winner_f1, count(*) AS n_candidates
FROM (SELECT experiment, run_id, position, coalesce(f1_macro, 0) AS f1_macro FROM runs)
GROUP BY experiment""", "experiment:str winner_run_id:str winner_f1:dbl n_candidates:int")
def best_candidate(t):
    """Best run per experiment by F1; the first listed wins ties."""
    return RG.best_candidate(V.runs(t))


@register("candidate_comparison", with_views(V_RUNS) + """
, w AS (SELECT experiment, arg_max(run_id, (coalesce(f1_macro, 0), -position)) AS winner FROM runs GROUP BY experiment)
SELECT r.experiment, r.run_id, r.f1_macro, r.accuracy, r.run_id = w.winner AS is_winner
FROM runs r JOIN w ON r.experiment = w.experiment""",
          "experiment:str run_id:str f1_macro:dbl accuracy:dbl is_winner:bool")
def candidate_comparison(t):
    """Every candidate echoed, the winner marked."""
    return RG.candidate_comparison(V.runs(t))


@register("pipeline_summary", _LEDGER_SQL + """
, c AS (SELECT *, CASE position % 3 WHEN 0 THEN 'distilbert-' ELSE 'baseline-' END || (position % 7) AS model_type FROM runs),
w AS (SELECT experiment, arg_max(model_type, (f1_macro, -position)) AS winner,
             arg_max(run_id, (f1_macro, -position)) AS run_id FROM c GROUP BY experiment),
b AS (SELECT experiment, arg_min(f1_macro, position) AS f1 FROM c WHERE model_type LIKE 'baseline%' GROUP BY experiment),
d AS (SELECT experiment, arg_min(f1_macro, position) AS f1 FROM c WHERE model_type LIKE 'distilbert%' GROUP BY experiment)
SELECT w.experiment, w.winner, b.f1 AS baseline_f1, d.f1 AS transformer_f1, l.promoted
FROM w LEFT JOIN b ON b.experiment = w.experiment LEFT JOIN d ON d.experiment = w.experiment
LEFT JOIN ledger l ON l.name = w.experiment AND l.run_id = w.run_id""",
          "experiment:str winner:str baseline_f1:dbl transformer_f1:dbl promoted:bool")
def pipeline_summary(t):
    """Each pipeline's summary row: winner, first F1 of each model
    family, and whether the winner was promoted."""
    kind = F.when(F.col("position") % 3 == 0, "distilbert-").otherwise("baseline-")
    c = V.runs(t).withColumn("model_type", F.concat(kind, (F.col("position") % 7).cast("string")))
    return RG.pipeline_summary(c, ledger_df(t))


@register("pipeline_failure_alerts", _RUNS_SQL + """
SELECT sha256('runfail:' || id) AS id, 'pipeline_failure' AS alert_type, 'warning' AS severity,
       'Pipeline failed: ' || dag_id || '/' || run_id AS message, coalesce(completed_at, started_at) AS created_at
FROM runs WHERE status = 'failed'""", "id:str alert_type:str severity:str message:str created_at:ts")
def pipeline_failure_alerts(t):
    """The declared pipeline_failure alert type, one per failed run row."""
    from ..operators import alerts as AL
    return AL.pipeline_failure_alerts(run_history_df(t))
