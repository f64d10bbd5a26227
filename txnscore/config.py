"""Settings handed to the scoring job as one argument; nothing is read from globals."""

from __future__ import annotations

from dataclasses import dataclass

# Decision threshold, trigger interval, intake limit and topic names.
FRAUD_THRESHOLD = 0.5
BATCH_INTERVAL_SECONDS = 5
MAX_OFFSETS_PER_TRIGGER = 10_000
INPUT_TOPIC = "raw_transactions"
ALERT_TOPIC = "fraud_alerts"


@dataclass(frozen=True)
class KafkaSettings:
    servers: str = "localhost:9092"
    input_topic: str = INPUT_TOPIC
    alert_topic: str = ALERT_TOPIC
    max_offsets_per_trigger: int = MAX_OFFSETS_PER_TRIGGER
    starting_offsets: str = "latest"
    fail_on_data_loss: bool = True
    # More read tasks than the topic has partitions, for intake that few partitions cannot score in time.
    min_partitions: int | None = None


@dataclass(frozen=True)
class ScoringConfig:
    threshold: float = FRAUD_THRESHOLD
    batch_interval_seconds: int = BATCH_INTERVAL_SECONDS


@dataclass(frozen=True)
class SinkPaths:
    """Tables of the scoring job, all in one folder that every executor can reach."""

    transactions: str
    alerts: str
    batch_metrics: str
    batch_series: str
    rejects: str
    sent: str
    failures: str

    @classmethod
    def under(cls, root: str) -> SinkPaths:
        root = root.rstrip("/")
        return cls(
            transactions=f"{root}/transactions",
            alerts=f"{root}/fraud_alerts",
            batch_metrics=f"{root}/batch_metrics",
            batch_series=f"{root}/batch_series",
            rejects=f"{root}/rejects",
            # The producer writes beside the scoring job, so its table is in a store of its own.
            sent=f"{root}/producer/sent",
            # Failures are stored while a batch is not, so in a store of their own, too.
            failures=f"{root}/health/failures",
        )
