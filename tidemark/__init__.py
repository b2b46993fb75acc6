"""Table work around a binary classifier, written as Spark DataFrame functions."""
