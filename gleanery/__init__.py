"""Corpus analytics on Spark: DataFrame operators for collected text records."""
