"""Chains of operators and model training."""
