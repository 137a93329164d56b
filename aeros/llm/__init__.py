"""Operators for preparing large text corpora on Spark."""
