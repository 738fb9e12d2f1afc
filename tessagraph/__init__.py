"""Property-graph, retrieval and graph-learning analytics on PySpark DataFrames."""

__version__ = "0.1.0"
