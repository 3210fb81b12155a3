"""Counters as rows, as JSON and as Prometheus text."""

from __future__ import annotations

import json

# Names under which the counters are published.
SCALARS = (
    "events_applied", "events_received", "transactions_committed", "transactions_received", "transactions_failed", "transactions_redelivered", "reconnects", "sink_errors",
    "schema_metadata_relation_messages", "schema_metadata_changes", "schema_metadata_unknown", "schema_apply_attempts", "schema_apply_success", "schema_apply_failure", "schema_apply_rejected",
)
STATUSES = ("COMPATIBLE", "INCOMPATIBLE", "UNKNOWN")
POSITIONS = ("last_processed_lsn", "last_confirmed_lsn")
_OWN_NAMES = {"events_applied": "cdc_events_total", "transactions_committed": "cdc_transactions_total"}
VALIDATIONS = "cdc_schema_validation_total"


def prometheus_name(name: str) -> str:
    return _OWN_NAMES.get(name, f"cdc_{name}_total")


def json_name(name: str) -> str:
    return f"cdc_{name}_total" if name.startswith("schema_") else name


def to_json(values: dict[str, int], statuses: dict[str, int], positions: dict[str, str]) -> str:
    """One object: scalar counters, validations by status, positions as text."""
    return json.dumps({json_name(k): int(values.get(k, 0)) for k in SCALARS} | {VALIDATIONS: {k.lower(): int(statuses.get(k, 0)) for k in STATUSES}} | {k: positions.get(k, "0/0") for k in POSITIONS})


def to_prometheus(values: dict[str, int], statuses: dict[str, int]) -> str:
    """Counter families with HELP and TYPE, a blank line between families, validations labelled by status."""
    out = []
    for k in SCALARS:
        name = prometheus_name(k)
        out.append(f"# HELP {name} Count of {k.replace('_', ' ')}.\n# TYPE {name} counter\n{name} {int(values.get(k, 0))}\n")
    lines = "".join(f'{VALIDATIONS}{{status="{k.lower()}"}} {int(statuses.get(k, 0))}\n' for k in STATUSES)
    out.append(f"# HELP {VALIDATIONS} Count of schema validations by status.\n# TYPE {VALIDATIONS} counter\n{lines}")
    return "\n".join(out)
