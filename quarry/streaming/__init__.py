"""Structured Streaming jobs (T1-T9), sinks (K2, K3) and the audited
per-micro-batch sink (L2)."""

from quarry.streaming.jobs import (  # noqa: F401
    batch_word_count, overwrite_each_batch, product_stream, raw_messages, run_append, run_complete,
    running_word_count, start_foreach_batch, start_pair, start_query, stream_word_count,
    trigger_kwargs,
)
from quarry.streaming.audit import run_audited  # noqa: F401
