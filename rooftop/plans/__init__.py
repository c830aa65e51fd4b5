"""Stages composed to a pipeline, and the queries that show each operator."""
