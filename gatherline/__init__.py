"""Event-intelligence analytics on Spark DataFrames: normalise, score, link, reconcile and gate event listings."""
