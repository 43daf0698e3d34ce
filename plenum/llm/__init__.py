"""Operators of a training-data pipeline.  Nothing else in plenum imports this subpackage."""
