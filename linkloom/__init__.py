"""A record-linkage and corpus-preparation engine on PySpark DataFrames."""

__version__ = "0.1.0"
