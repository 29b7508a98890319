"""Keyed zone tables: commit-log semantics and their storage with catalog entries."""
