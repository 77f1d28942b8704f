"""Article ingest over tables of web-page snapshots, written with Spark DataFrames."""

from presskiln.session import tune

__all__ = ["tune"]
__version__ = "0.1.0"
