"""Readers: raw yearly files, commune centres, département outlines, the
driver's TPC-H-like tables (test adapter) and published snapshots."""
