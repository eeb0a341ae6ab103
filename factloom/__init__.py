"""factloom: a PySpark-native engine for disclosure facts and the text they come from."""

__version__ = "0.1.0"
