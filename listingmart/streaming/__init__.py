"""Incremental landing scan: file stream with availableNow feeding the batch plans."""
