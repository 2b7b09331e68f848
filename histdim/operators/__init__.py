"""Pipelines: cumulative dimension, SCD2, facts, analyses."""
