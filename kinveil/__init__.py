"""kinveil: record linkage for data holders, written for Spark DataFrames."""
