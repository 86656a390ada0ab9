"""Assay screening results on Spark: consolidate readings, pair plots with compounds, prepare bar charts."""
