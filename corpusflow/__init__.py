"""PySpark operators for corpus, alignment and evaluation tables."""
