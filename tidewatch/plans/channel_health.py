"""One full run: raw channel/video frames -> features -> EDA -> scoring ->
report, star tables, drift and alerts, keyed tables. The library's operators
composed in the order of the reference's runner (SURVEY §3.4), with the merge
after the features and clusters are computed (not before, §3.4's order flaw).

Every output is written under ``out_dir``; earlier runs' outputs (drift
baselines, previous report, keyed-table versions) are read from
``state_dir`` when present.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import eda as ED
from ..operators import features as FE
from ..operators import merge as MG
from ..operators import modeling as MD
from ..operators import monitor as MO
from ..operators import reports as RP
from ..session import configure, exists
from ..sinks import files as SK
from ..sources import landing as LD

DRIFT_COLS = ["upload_freq_30d", "upload_freq_90d", "freq_trend_ratio", "momentum_ratio", "avg_engagement_rate",
              "days_since_last_upload", "upload_regularity", "duration_trend"]


@dataclass
class RunResult:
    features: DataFrame
    clusters: DataFrame
    report: DataFrame
    eda: DataFrame
    feature_drift: DataFrame
    cluster_drift: DataFrame
    new_at_risk: DataFrame
    freshness: DataFrame
    metrics: dict
    paths: dict = field(default_factory=dict)


def run(spark: SparkSession, channels: DataFrame, videos: DataFrame, ref, out_dir: str, state_dir: str,
        version: int, short: int = 30, long: int = 90, min_videos: int = 2, model_type: str = "auto",
        min_clusters: int = 3, max_clusters: int = 5, n_boot: int = 500, seed: int = 42,
        channel_key: str = "channel_id") -> RunResult:
    """Compute and write one run. ``version`` numbers the runs' state
    (merging the newest run again changes nothing)."""
    configure(spark)
    out, st = out_dir.rstrip("/"), state_dir.rstrip("/")
    paths = {}

    feats_path = SK.write_snapshot(FE.compute_features(channels, videos, ref, short, long, min_videos), f"{out}/features")
    features = spark.read.parquet(feats_path)
    paths["features"] = feats_path

    eda = ED.eda_report(features)
    paths["eda"] = SK.write_snapshot(eda, f"{out}/eda")

    scored = MD.score_creators(features, S.ts_lit(ref), model_type, min_clusters, max_clusters, seed, n_boot)
    paths["clusters"] = SK.write_snapshot(scored.clusters, f"{out}/clusters")
    clusters = spark.read.parquet(paths["clusters"])
    paths["model"] = MD.save_model(scored, f"{out}/model")

    # A report of clusters and features that share no id is empty (stale inputs).
    fresh = MO.freshness(clusters, features, channel_key)
    report = RP.at_risk_report(clusters, features, channels).where(F.lit(bool(fresh.first()["ok"])))
    paths["report"] = SK.write_report_csv(report, f"{out}/report", single_file=False)
    dim, fact = RP.export_star(clusters, features, S.ts_lit(ref))
    paths["dim_channel"] = SK.write_report_csv(dim, f"{out}/dim_channel")
    paths["fact_creator_metrics"] = SK.write_report_csv(fact, f"{out}/fact_creator_metrics")

    # Monitoring against the newest earlier version's state (first run: store
    # only). State is kept per version, so a replay compares with the same run
    # as the first time and not with itself.
    earlier = [v for v in range(version - 1, 0, -1) if exists(spark, f"{st}/state/version={v}/previous_report")][:1]
    before, now = f"{st}/state/version={earlier[0] if earlier else 0}", f"{st}/state/version={version}"
    fbase = spark.read.parquet(f"{before}/feature_baseline") if earlier else None
    cbase = spark.read.parquet(f"{before}/cluster_baseline") if earlier else None
    f_rep, f_new = MO.feature_drift(features, fbase, DRIFT_COLS)
    c_rep, c_new = MO.cluster_drift(clusters, cbase)
    paths["feature_drift"] = SK.write_snapshot(f_rep, f"{out}/feature_drift")
    paths["cluster_drift"] = SK.write_snapshot(c_rep, f"{out}/cluster_drift")
    prev_report = LD.read_previous_report(spark, f"{before}/previous_report")
    paths["new_at_risk"] = SK.write_snapshot(MO.new_at_risk(report, prev_report, channel_key), f"{out}/new_at_risk")

    # Keyed tables: merge after computing (the newest run again changes nothing).
    MG.merge_into(spark, f"{st}/tables/creator_features", features, [channel_key])
    MG.merge_into(spark, f"{st}/tables/creator_clusters", MG.with_algorithm(clusters), [channel_key])

    # State for the next run, written last.
    SK.save_baseline(f_new, f"{now}/feature_baseline")
    SK.save_baseline(c_new, f"{now}/cluster_baseline")
    SK.write_report_csv(report, f"{now}/previous_report")
    return RunResult(features, clusters, spark.read.option("header", True).csv(paths["report"]), eda,
                     spark.read.parquet(paths["feature_drift"]), spark.read.parquet(paths["cluster_drift"]),
                     spark.read.parquet(paths["new_at_risk"]), fresh, scored.metrics, paths)

