"""Baselines and MLlib classifiers."""
