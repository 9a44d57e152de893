"""Implicit-feedback recommendation analytics as composable Spark DataFrame operators."""
