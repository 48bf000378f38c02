"""Incremental materialization of newly arriving sessions."""
from .incremental import SESSION_ARRIVALS, materialize_arrivals, restrict_inputs

__all__ = ["SESSION_ARRIVALS", "materialize_arrivals", "restrict_inputs"]
