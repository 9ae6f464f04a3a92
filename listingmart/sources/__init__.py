"""Inputs and storage: landed listing pages (S1-S6, S11, S12), lookup lists and the fixed value
maps (S7, F22), and the parquet table store (versioned / date-partitioned tables, K1-K8, S13)."""
