"""Structured Streaming pipelines with replay-safe sinks (STM-*, SNK-1/2/3/11)."""

from aspectflow.streaming.pipelines import (  # noqa: F401
    FailOnce, batch_sink, kafka_reader, replay_source, run_stream,
)
