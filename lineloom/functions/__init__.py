"""Scalar functions: native column expressions, and plain Python ones for use within Arrow batches."""
