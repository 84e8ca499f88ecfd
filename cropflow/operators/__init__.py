"""cropflow.operators."""
