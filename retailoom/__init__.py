"""A layered retail warehouse on Spark: raw tables -> star schema -> rollups -> reports."""

__version__ = "0.1.0"
