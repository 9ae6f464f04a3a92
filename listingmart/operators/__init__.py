"""DataFrame operators: keys (M7, M8, M10), de-duplication (A1-A8, A16), upsert and
insert-if-absent (M1-M3), counter deltas (W2-W4), lookups and translation (J10, A9, C9),
checks (M11-M14, P11, P18, S12), value standardisation (C8), paging (O2, O4)."""
