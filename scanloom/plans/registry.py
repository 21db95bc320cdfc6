"""Query registry: each entry is a Spark plan and, where SQL can say it, its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scanloom.plans import views
from scanloom.session import tune

_QUERIES: dict[str, Callable] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        assert name not in _QUERIES, name
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load()

    def bind(fn):
        return lambda spark, sf_dir: fn(views.Tables(tune(spark, False), sf_dir))
    return {k: bind(f) for k, f in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    load()
    return {k: views.with_views(s) for k, s in _SQL.items()}


#: Ordered queries that are registered again with small splits (rows a split), so
#: that the plan of large inputs is compared at every size.
SPLIT = {"p05_drop_repeats": 3000, "p06_normalise_livox": 30000, "p09_normalise_velodyne_yaw": 3000, "w14_ring_differences": 3000, "w15_point_labels": 3000, "a02_quantile_ground_seed": 3000,
         "j01_asof_interpolate": 300, "j05_correction_asof": 300, "a22_error_metrics": 100, "a22_a25_metrics_report": 400, "w02_gap_sessions": 300, "w03_state_runs": 40, "w08_gap_bridges": 40, "t01_stable_time_sort": 300,
         "st07_object_tracks_batch": 4000, "g12_edge_tracks": 150, "s13_point_list": 500}


def over_splits(fn, rows: int):
    """``fn`` with ``rows`` rows a split; splits are made while the plan is built."""
    def run(t):
        from scanloom.operators import ordered
        usual, ordered.ROWS_PER_SPLIT = ordered.ROWS_PER_SPLIT, rows
        try:
            return fn(t)
        finally:
            ordered.ROWS_PER_SPLIT = usual
    return run


def load() -> None:
    import importlib
    import importlib.util
    for m in ("points", "trajectories", "evidence", "terrain", "boundaries", "objects", "products", "audit", "streams"):
        if importlib.util.find_spec(f"scanloom.plans.{m}"):
            importlib.import_module(f"scanloom.plans.{m}")
    for name, rows in SPLIT.items():
        if name + "_splits" not in _QUERIES:
            query(name + "_splits", _SQL.get(name))(over_splits(_QUERIES[name], rows))
