"""Whole jobs built from sources, operators and sinks."""
