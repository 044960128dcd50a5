"""Writing: text, partitioned files, compaction, batched and replay-safe sinks."""
