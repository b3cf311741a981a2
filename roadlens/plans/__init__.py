"""Plan-level building blocks: hot-key splitting and the one-run job."""
