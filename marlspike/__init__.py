"""Feature engineering, sampling, text preparation, joint training,
scoring and evaluation over Spark DataFrames."""

__version__ = "0.1.0"
