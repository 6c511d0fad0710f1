"""prepforge: a PySpark engine for preparing, modelling and judging binary-response tables."""

__version__ = "0.1.0"
