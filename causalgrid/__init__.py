"""causalgrid: keyed, multi-frequency time series on Spark, without leaking the future."""
