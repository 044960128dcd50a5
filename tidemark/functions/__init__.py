"""Scalar expressions and user functions."""
