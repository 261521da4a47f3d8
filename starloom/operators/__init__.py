"""Reusable DataFrame operators: keys, flattening, versioning, running totals, checks."""

from starloom.operators.checks import (
    column_profile,
    declared_key_violations,
    duplicate_keys,
    key_violations,
    orphan_counts,
    orphan_rows,
    profile_violations,
)
from starloom.operators.flatten import Lookup, flatten
from starloom.operators.keys import (
    current_rows,
    dense_key,
    fits_broadcast,
    small_lookup,
    resolve_key,
)
from starloom.operators.running import running_totals
from starloom.operators.versioning import initial_version

__all__ = [
    "column_profile", "declared_key_violations", "duplicate_keys", "key_violations", "orphan_counts", "orphan_rows", "profile_violations", "Lookup",
    "flatten", "current_rows", "dense_key", "fits_broadcast", "small_lookup",
    "resolve_key",
    "running_totals", "initial_version",
]
