"""Joins, aggregates and windows of the transform."""
