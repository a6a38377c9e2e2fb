"""Readers, layout normalization, admission and sinks."""
