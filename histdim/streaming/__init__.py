"""Continuous feeds for the increment (foreachBatch)."""
