"""Paid-acquisition analytics as DataFrame -> DataFrame operators for Spark."""
