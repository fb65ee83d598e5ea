"""barsmith: market-bar analytics as ordinary Spark DataFrame operators.

Bars are ``(symbol, datetime, open, high, low, close, volume)`` rows.  Every
operator takes and returns a DataFrame, keyed by ``symbol``, so one plan
serves batch history and Structured Streaming alike.
"""

__version__ = "0.1.0"
