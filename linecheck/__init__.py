"""Line inspection analytics on Spark DataFrames."""
