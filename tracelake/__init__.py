"""tracelake: conversation-shaped analytics as Spark DataFrames."""

__version__ = "0.1.0"
