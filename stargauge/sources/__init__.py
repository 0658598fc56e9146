"""Snapshot files, API payloads and catalog tables."""
