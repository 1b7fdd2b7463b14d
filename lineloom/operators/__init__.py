"""Operators over DataFrames of lines, records, rubbish, dead letters, templates, jobs and events."""
