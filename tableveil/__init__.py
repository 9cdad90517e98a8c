"""Spark jobs that copy tables safely and prove that the copies are right."""
