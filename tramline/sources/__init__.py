"""Scans: driver tables, derived transit tables, typed CSV / text sources."""
