"""Training-sample preparation for click models, as Spark DataFrame operators."""
