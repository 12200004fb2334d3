"""Model training, evaluation and scoring on ``pyspark.ml``."""
