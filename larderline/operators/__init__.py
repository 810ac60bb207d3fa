"""Joins, aggregates and selections: functions from DataFrames to DataFrames."""
