"""Operators for preparing training text: deduplication, decontamination, scans, scoring and mixing.

Nothing outside this subpackage imports it.
"""
