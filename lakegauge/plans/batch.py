"""Batch run over layers of datasets: baselines where needed, validation, history, roll-ups."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lakegauge.contract import Contract
from lakegauge.plans import baseline as bl
from lakegauge.plans import history, summary, validate
from lakegauge.session import small_table
from lakegauge.sources.inventory import yesterday

_MEMBERS = pa.schema([("layer", pa.string()), ("dataset", pa.string())])


@dataclass
class Run:
    results: DataFrame | None       # check_results of every dataset that could be validated
    errors: DataFrame               # datasets that could not, with the reason
    statuses: DataFrame             # per layer and dataset, by the dimensions of the layer
    exit_code: int                  # 1 if any dataset failed or is broken


def run_layers(spark: SparkSession, layers: dict[str, dict[str, Contract]], root: str, *, where: str = "s3",
               day: str | None = None, rebuild: bool = True, mode: str = "backfill", fallback_latest: bool = False,
               limits: dict[str, float] | None = None, parallel: int = 4, now: dt.datetime | None = None,
               sources: dict[str, DataFrame | Callable[[], DataFrame]] | None = None, **options) -> Run:
    """Validate one partition of every dataset: of ``day``, of yesterday by default, the newest for 'auto'.

    Datasets run ``parallel`` at a time, each under its limit in seconds if ``limits`` names one. ``sources`` has the relations
    behind landed tables, by dataset. Baselines live under ``root/baselines``, results are appended under ``root``.
    """
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    chosen = None if day == "auto" else day or yesterday(now)
    run_id, baselines = uuid.uuid4().hex, f"{root.rstrip('/')}/baselines"
    contracts = {n: c for members in layers.values() for n, c in members.items()}
    stale = set(bl.to_build(spark, baselines, list(contracts), rebuild))

    def job(c: Contract):
        def run() -> DataFrame:
            if c.name in stale:
                validate.build_baseline(spark, c, baselines, where)
            b = bl.load(spark, baselines, c.name)
            return validate.validate(spark, c, b, where=where, day=chosen, fallback_latest=fallback_latest, now=now, mode=mode,
                                  run_id=run_id, source_table=(sources or {}).get(c.name), **options)
        return run

    results, errors = history.run_all(spark, {n: job(c) for n, c in contracts.items()}, limits, parallel)
    members = small_table(spark, [{"layer": k, "dataset": n} for k, ms in layers.items() for n in ms], _MEMBERS)
    if results is None:
        empty = members.limit(0).selectExpr("layer", "dataset", "cast(null as string) category", "cast(null as string) severity",
                                            "cast(null as boolean) success")
        statuses = summary.dataset_status(empty, members)
    else:
        history.append(results, root)
        layered = summary.with_layers(results, members)
        history.append_layer_summary(layered, root, now.date().isoformat())
        statuses = summary.dataset_status(layered, members)
    return Run(results, errors, statuses, summary.layer_gate(statuses).first()[0])
