"""Whole jobs: demand variants, full load, evaluation, experiment analysis."""
