"""Dashboard outputs composed from the operators.

Each returns a dict of small DataFrames; every piece is also a registered,
oracle-checked query.
"""

from __future__ import annotations

from datetime import date

from ..config import DEFAULT, Config
from ..operators import alerts as AL
from ..operators import drift as D
from ..operators import metrics as M
from ..operators import registry as RG
from ..operators import runs as RN
from ..sources import views as V
from ..sources.tables import Tables


def _reports(t: Tables, cfg: Config):
    return D.drift_reports(V.profile(t, cfg), list(V.PROFILE_FEATURES), cfg)


def _alerts(t: Tables, cfg: Config):
    a = AL.alerts_from_reports(_reports(t, cfg), cfg)
    return AL.apply_resolutions(a, AL.resolutions_before(a, cfg.resolve_before, cfg))


def overview(t: Tables, day: date, cfg: Config = DEFAULT) -> dict:
    """O1: KPIs with the Production version, 14-day volume, five newest alerts."""
    p = V.predictions(t, cfg)
    ledger = RG.promotion_ledger(V.model_versions(t, cfg))
    return {"summary": M.summary(p, _reports(t, cfg), day, *RG.production(ledger, cfg.registry_name), cfg=cfg),
            "volume": M.prediction_volume(p, cfg.as_of, days=14),
            "alerts": M.recent_alerts(_alerts(t, cfg), 5)}


def drift_page(t: Tables, days: int = 30, cfg: Config = DEFAULT) -> dict:
    """O2: drift history, latest report and its status."""
    r = _reports(t, cfg)
    return {"history": M.drift_history(r, cfg.as_of, days), "latest": M.latest_status(r, cfg)}


def predictions_page(t: Tables, days: int = 7, cfg: Config = DEFAULT) -> dict:
    """O3: percentiles, label counts and shares, histogram, newest rows."""
    p = V.predictions(t, cfg)
    return {"latency": M.latency_percentiles(p, cfg.as_of, days),
            "distribution": M.sentiment_distribution(p, cfg.as_of, days),
            "share": M.sentiment_share(p, cfg.as_of, days),
            "confidence": M.confidence_histogram(p, cfg.as_of, days),
            "recent": M.recent_predictions(p)}


def experiments_page(t: Tables, cfg: Config = DEFAULT) -> dict:
    """Newest runs per experiment, as a leaderboard."""
    rows = RG.experiment_runs(V.runs(t), None, cfg.runs_per_experiment)
    return {"runs": rows, "leaderboard": RG.leaderboard(rows)}


def registry_page(t: Tables, cfg: Config = DEFAULT) -> dict:
    """Versions with stage and metrics."""
    led = RG.promotion_ledger(V.model_versions(t, cfg))
    return {"versions": RG.version_metrics(led, V.runs(t)),
            "current": RG.current_versions(led)}


def runs_page(t: Tables, cfg: Config = DEFAULT) -> dict:
    """Run history, newest runs and per-DAG summary."""
    h = RN.fold_runs(V.run_events(t))
    return {"recent": M.recent_runs(h), "summary": RN.run_summary(h),
            "failures": AL.pipeline_failure_alerts(h)}
