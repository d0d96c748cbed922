"""Property graphs as DataFrames: blueprints compiled to joins and windows, and pattern queries on them."""
