"""chronoweave — aligned multi-device sensor sessions as Spark DataFrames.

Every public function takes and returns DataFrames keyed by ``session_id`` so
many sessions are materialized, validated and packaged in one Spark job.
"""
from .schemas import SCHEMA_VERSION, ENGINE_VERSION

__all__ = ["SCHEMA_VERSION", "ENGINE_VERSION"]
