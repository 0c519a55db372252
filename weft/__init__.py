"""weft: typed graph tables, text features and corpus operators on PySpark."""
