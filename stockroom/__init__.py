"""stockroom: event-sourced inventory analytics as Spark DataFrame, SQL and streaming jobs.

Every public function takes and returns DataFrames. ``org`` arguments are optional:
``None`` runs the job for all tenants at once, grouped by ``organization_id``.
"""

from stockroom.session import build_session, ensure_session_defaults, work_dir

__all__ = ["build_session", "ensure_session_defaults", "work_dir"]
