"""Readers and writers: source tables, event logs, snapshots, CSV and messages."""
