"""tidemark: panel feature engineering and time-ordered model evaluation on Spark."""

__version__ = "0.1.0"
