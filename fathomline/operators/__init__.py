"""Operators on DataFrames: cleaning, trajectories, cells, heatmaps, dimensions, partitions."""
