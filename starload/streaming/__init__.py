"""Structured Streaming: the message consumer as a checkpointed foreachBatch query."""
