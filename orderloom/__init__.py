"""Order analytics on Spark: land CSV drops, clean, model, check and publish them."""

__version__ = "0.1.0"
