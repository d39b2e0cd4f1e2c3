"""DataFrame -> DataFrame operators.

staging   stage (R1), dedupe_latest (R2: partial WindowGroupLimit, total order)
keys      with_default_member (R4), resolve_fk (R5), broadcast_if_small (hint for bounded tables only)
snapshot  periodic_snapshot (R7), regime_weighted_avg (R8)
star      drill_across (R11)
preview   preview (R12)
sinks     write_table, create_view, create_namespaces (K1-K5, K7)
quality   duplicate_keys, orphan_keys, stale_heights, broken_links (E2, E6)
"""
