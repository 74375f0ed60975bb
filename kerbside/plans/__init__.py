"""Multi-stage jobs composed of operators and ``pyspark.ml`` estimators."""
