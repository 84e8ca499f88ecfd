"""cropflow.sources."""
