"""Structured Streaming jobs.

Each query keeps its position in a checkpoint, so a restart goes on where it stopped.
Batch callbacks write to a folder named after the batch and overwrite it, so a batch
that is replayed after a failure replaces its own output.
"""
