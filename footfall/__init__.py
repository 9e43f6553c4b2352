"""App-behaviour analytics over event logs, on Spark DataFrames and streams."""
