"""Fitting, stacking, scoring and explaining classifiers with ``pyspark.ml``."""
