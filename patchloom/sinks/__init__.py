"""Sinks: tables, keyed feature tables, image files and reports."""
