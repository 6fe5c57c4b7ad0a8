"""Batch operators: plain functions from DataFrames to a DataFrame, left to Catalyst to plan."""
