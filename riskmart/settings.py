"""Session settings these jobs run well with; pass them to the session builder."""

from __future__ import annotations

# Past this many bytes of bytecode the JVM does not compile a method at all.
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")

RECOMMENDED = {
    # Runtime re-planning: joins and rebalanced writes split large partitions, merge small ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The cleaning projections are wide; such a stage is better split up than fused into one method. Writes of tables set this
    # themselves (``sources.scratch.compiled``).
    METHOD_LIMIT[0]: METHOD_LIMIT[1],
    # Dates are compared with dates; nothing may depend on the zone of a machine.
    "spark.sql.session.timeZone": "UTC",
}

# For sessions that join bucketed tables (sources/bucketed.py): rows that lie together by some of the join's keys are not shuffled
# again by all of them.
CO_LOCATED = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
