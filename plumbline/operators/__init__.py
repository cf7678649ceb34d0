"""Dataset-level operators over DataFrames."""
