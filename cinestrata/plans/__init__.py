"""Whole jobs: reports, model sets, models, evaluation, scoring and layer runs."""
