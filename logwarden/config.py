"""Pipeline settings, read from the environment; credentials have no defaults."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field


CORE_RULE_NAMES = (
    "brute_force", "port_scan", "web_scan", "data_exfiltration", "lateral_movement",
)


@dataclass(frozen=True)
class PipelineConfig:
    checkpoint_root: str
    archive_root: str
    broker: str = "kafka:9092"
    topics: Mapping[str, str] = field(
        default_factory=lambda: {
            "auth": "auth-logs",
            "firewall": "firewall-logs",
            "web": "web-logs",
        }
    )
    trigger_seconds: int = 10
    watermark: str = "30 seconds"
    starting_offsets: str = "latest"
    # Input cap per topic and trigger; without one, a batch takes all that has come.
    max_offsets_per_trigger: int | None = None
    distinct: str = "approx"
    # Names of the rules to run, see `logwarden.operators.rules.REGISTRY`.
    rules: tuple[str, ...] = CORE_RULE_NAMES
    tables_root: str = ""

    @property
    def alert_table(self) -> str:
        return f"{self.tables_root or self.archive_root + '-tables'}/alerts"

    @property
    def stats_table(self) -> str:
        return f"{self.tables_root or self.archive_root + '-tables'}/traffic_stats"

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> PipelineConfig:
        defaults = cls(checkpoint_root="/app/data/checkpoints", archive_root="/app/data/parquet")
        cap = env.get("MAX_OFFSETS_PER_TRIGGER", "none")
        return cls(
            checkpoint_root=env.get("CHECKPOINT_PATH", defaults.checkpoint_root),
            archive_root=env.get("PARQUET_OUTPUT_PATH", defaults.archive_root),
            broker=env.get("KAFKA_BROKER", defaults.broker),
            topics={
                topic: env.get(f"KAFKA_TOPIC_{topic.upper()}", name)
                for topic, name in defaults.topics.items()
            },
            trigger_seconds=int(env.get("SPARK_BATCH_INTERVAL", defaults.trigger_seconds)),
            max_offsets_per_trigger=None if cap == "none" else int(cap),
            rules=tuple(env["RULES"].split(",")) if env.get("RULES") else defaults.rules,
            tables_root=env.get("TABLE_OUTPUT_PATH", defaults.tables_root),
        )


@dataclass(frozen=True)
class DatabaseConfig:
    url: str
    user: str
    password: str = field(repr=False)
    driver: str = "org.postgresql.Driver"

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> DatabaseConfig:
        needed = ("POSTGRES_USER", "POSTGRES_PASSWORD", "POSTGRES_DB")
        missing = [name for name in needed if not env.get(name)]
        if missing:
            raise OSError("missing environment variables: " + ", ".join(missing))
        host, port = env.get("POSTGRES_HOST", "postgres"), env.get("POSTGRES_PORT", "5432")
        url = f"jdbc:postgresql://{host}:{port}/{env['POSTGRES_DB']}"
        return cls(url=url, user=env["POSTGRES_USER"], password=env["POSTGRES_PASSWORD"])
