"""Operators of a training-data pipeline. Each module states its method, its parameters and what it does with odd input."""
