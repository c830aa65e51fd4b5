"""rooftop: building-footprint fusion and height analytics on Spark DataFrames."""
