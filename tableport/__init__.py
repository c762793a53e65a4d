"""Move tables with Spark and prove that they moved intact."""

from .operators.constraints import Check, Constraints, ForeignKey, Key, constraint_report
from .operators.graph import dependency_levels, topological_order
from .operators.reconcile import fingerprints, reconcile
from .operators.telemetry import counter_rates, grade, summary, timeline, verdict
from .operators.throughput import chunk_summary, compare_runs, heartbeat, knee, progress, ramp
from .plans.chunking import ChunkPlan, modulo_plan, ntile_plan, range_plan
from .plans.export import export_tables
from .plans.inventory import inventory, inventory_totals, key_profile, lob_profile, plan_tables, sample
from .plans.restore import restore_tables
from .session import build_session
from .sources.bundle import check_bundle, open_bundle
from .sources.jdbc import JdbcDatabase
from .sources.targets import CatalogTarget, JdbcTarget, PathTarget

__all__ = [
    "CatalogTarget", "Check", "ChunkPlan", "Constraints", "ForeignKey", "JdbcDatabase", "JdbcTarget", "Key",
    "PathTarget", "build_session", "check_bundle", "chunk_summary", "compare_runs", "constraint_report",
    "counter_rates", "dependency_levels", "export_tables", "fingerprints", "grade", "heartbeat", "inventory",
    "inventory_totals", "key_profile", "knee", "lob_profile", "modulo_plan", "ntile_plan", "open_bundle",
    "plan_tables", "progress", "ramp", "range_plan", "reconcile", "restore_tables", "sample", "summary",
    "timeline", "topological_order", "verdict",
]
