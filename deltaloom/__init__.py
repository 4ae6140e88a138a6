"""Change data, ownership and pending-write operators over Spark DataFrames."""
