"""Verdant: a Spark-native engine for sustainability-disclosure analytics.

Pages, chunks, extracted facts and observations are DataFrames; every stage is a
DataFrame -> DataFrame function whose plan Catalyst can see.  Python runs only where
no built-in expression has the same meaning, and then on Arrow batches.
"""

__version__ = "0.1.0"
