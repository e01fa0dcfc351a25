"""Incremental ingestion with checkpoints and idempotent batches."""
