"""Scans: object listing, object reads, descriptors, dataset layouts, session metadata, taxonomy."""
