"""The row-wise part of the pipeline over streams."""
