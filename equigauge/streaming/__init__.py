"""The audit on Structured Streaming: running counts, epoch audits, monitoring."""
