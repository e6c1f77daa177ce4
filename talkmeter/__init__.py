"""talkmeter: conversation-quality analytics as PySpark jobs.

Every operator takes DataFrames and returns a DataFrame; thresholds, patterns,
cut dates and clocks are keyword arguments.
"""

__version__ = "0.1.0"
