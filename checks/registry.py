"""All registered queries."""

from __future__ import annotations

from checks import ingest_checks, quality_checks, rollup_checks, session_checks

ALL = {
    **rollup_checks.CHECKS,
    **session_checks.CHECKS,
    **ingest_checks.CHECKS,
    **quality_checks.CHECKS,
}
