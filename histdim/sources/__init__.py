"""Readers of the pipeline tables and their derivation from the driver tables."""
