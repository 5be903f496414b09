"""Silver, gold and report plans: DataFrame in, DataFrame out, no I/O."""
