"""Parameters of the operators, as frozen dataclasses."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from . import fixed_values as fv


@dataclass(frozen=True)
class Windowing:
    """Event-time window: ``slide_s`` unset means tumbling."""

    length_s: int = 60
    slide_s: int | None = None

    def __post_init__(self) -> None:
        if self.length_s <= 0 or (self.slide_s is not None and not 0 < self.slide_s <= self.length_s):
            raise ValueError(f"need 0 < slide <= length, got {self}")

    @property
    def sliding(self) -> bool:
        return self.slide_s is not None and self.slide_s != self.length_s

    @property
    def divisible(self) -> bool:
        return self.slide_s is None or self.length_s % self.slide_s == 0

    @property
    def length(self) -> str:
        return f"{self.length_s} seconds"

    @property
    def slide(self) -> str:
        return f"{self.slide_s or self.length_s} seconds"


MINUTE = Windowing(60)
MINUTE_BY_TEN = Windowing(60, 10)


@dataclass(frozen=True)
class Thresholds:
    latency_ms: float = fv.HIGH_LATENCY_MS
    error_rate: float = fv.ERROR_RATE_BATCH
    critical_error_rate: float = fv.CRITICAL_ERROR_RATE
    critical_latency_ms: float = fv.CRITICAL_LATENCY_MS
    spike_factor: float = fv.SPIKE_FACTOR
    consecutive_errors: int = fv.CONSECUTIVE_ERRORS
    alert_error_rate: float | None = None  # window alerts need a higher rate, if given


BATCH_THRESHOLDS = Thresholds()
LIVE_THRESHOLDS = Thresholds(error_rate=fv.ERROR_RATE_LIVE)


@dataclass(frozen=True)
class Settings:
    """Everything a batch or streaming job needs besides its input and output."""

    thresholds: Thresholds = BATCH_THRESHOLDS
    window: Windowing = MINUTE
    live_window: Windowing = MINUTE_BY_TEN
    keywords: tuple[str, ...] = fv.ERROR_KEYWORDS
    dimensions: tuple[str, ...] = ("service", "host", "log_level", "status_code")
    top_services: int = 5
    watermark: str = "10 minutes"
    trigger: str = "5 seconds"
    kafka_servers: str = "localhost:9092"
    raw_topic: str = fv.RAW_TOPIC

    @classmethod
    def from_config(cls, config: Mapping) -> Settings:
        """Read the nested application-config layout (``spark.streaming``, ``processing`` ...)."""
        stream = config.get("spark", {}).get("streaming", {})
        processing = config.get("processing", {})
        detection = processing.get("anomaly_detection", {})
        alerting = config.get("alerting", {})
        toggles = processing.get("aggregation", {})
        kafka = config.get("kafka", {})
        base = cls()
        limits = replace(
            base.thresholds,
            latency_ms=detection.get("response_time_threshold_ms", base.thresholds.latency_ms),
            error_rate=detection.get("error_rate_threshold", base.thresholds.error_rate),
            spike_factor=detection.get("spike_threshold", base.thresholds.spike_factor),
            critical_latency_ms=alerting.get("critical_response_time_ms", base.thresholds.critical_latency_ms),
            alert_error_rate=alerting.get("high_error_rate_threshold", base.thresholds.alert_error_rate),
            consecutive_errors=alerting.get("consecutive_errors_threshold", base.thresholds.consecutive_errors),
        )
        return replace(
            base,
            thresholds=limits,
            live_window=Windowing(
                stream.get("window_duration_seconds", base.live_window.length_s),
                stream.get("slide_duration_seconds", base.live_window.slide_s),
            ),
            keywords=tuple(processing.get("error_keywords", base.keywords)),
            dimensions=tuple(d for d in base.dimensions if toggles.get(f"by_{d}", True)),
            trigger=f"{stream.get('trigger_interval_seconds', 5)} seconds",
            kafka_servers=kafka.get("bootstrap_servers", base.kafka_servers),
            raw_topic=kafka.get("producer", {}).get("topic", base.raw_topic),
        )
