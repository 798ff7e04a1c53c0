"""Charging-order behaviour analytics as Spark DataFrame functions."""
