"""Composite jobs: cleaning (C1, C2), staging and snapshots (K2-K5, C3, C4), star schema and
daily metrics (C5, C6), gold (C7), the daily run over both sources, and the constraint audit."""
