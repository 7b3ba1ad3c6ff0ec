"""Spatio-temporal raster catalog analytics on Spark DataFrames."""
