"""Readers and writers for event logs, scenario files and record tables."""
