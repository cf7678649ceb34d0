"""Contract-driven table moves, reconciliation and change capture on Spark DataFrames."""
