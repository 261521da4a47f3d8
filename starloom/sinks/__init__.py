"""Sinks: schema-conforming table writer with row counts and digests, the manifest of runs, and staging folders."""

from starloom.sinks.digest import table_digest
from starloom.sinks.manifest import PublishConflict, create_views, current_manifest, expire_runs
from starloom.sinks.staging import drop_staging, stage, stage_counted, staging_mark, staging_path
from starloom.sinks.writer import Written, write_table

__all__ = ["PublishConflict", "Written", "create_views", "current_manifest", "drop_staging", "expire_runs", "stage",
           "stage_counted", "staging_mark", "staging_path", "table_digest", "write_table"]
