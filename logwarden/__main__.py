"""Run the pipeline: `spark-submit --packages <kafka connector>,<postgres driver> -m logwarden`.

Settings come from the environment; see `logwarden.config`.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from logwarden.config import DatabaseConfig, PipelineConfig
from logwarden.sinks.tables import jdbc_table
from logwarden.streaming.progress import ProgressLog
from logwarden.streaming.pipeline import start_pipeline, streaming_session


def main() -> None:
    config, database = PipelineConfig.from_env(), DatabaseConfig.from_env()
    spark = SparkSession.builder.appName("logwarden").getOrCreate()
    session = streaming_session(spark)
    log = ProgressLog()
    session.streams.addListener(log)
    start_pipeline(
        session,
        config,
        alert_sink=jdbc_table("alerts", database),
        stats_sink=jdbc_table("traffic_stats", database),
    )
    while not session.streams.awaitAnyTermination(timeout=60):
        log.flush(session, f"{config.archive_root}-progress")
    log.flush(session, f"{config.archive_root}-progress")


if __name__ == "__main__":
    main()
