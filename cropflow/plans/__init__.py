"""cropflow.plans."""
