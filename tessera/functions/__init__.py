"""Column expressions: temporal, numeric, bucketing, text and log-field helpers."""

from tessera.functions import buckets, logs, numeric, temporal, text

__all__ = ["buckets", "logs", "numeric", "temporal", "text"]
