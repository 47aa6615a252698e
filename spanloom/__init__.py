"""Interval, sequence and dense-signal analytics as Spark DataFrame plans."""
