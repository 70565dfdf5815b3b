"""Readers: log lines, log layouts, encoded logs, typed log tables, reports."""
