"""cellwatch: wildfire-risk analytics per grid cell and day, on Spark DataFrames."""
