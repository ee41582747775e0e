"""Variability classification of irregularly sampled series, on Spark."""

__version__ = "0.1.0"
