"""Analytics over speaker-attributed document corpora, expressed in Spark DataFrames."""
