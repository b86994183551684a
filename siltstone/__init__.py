"""A PySpark library that turns raw document collections into analysis-ready and training-ready tables."""
