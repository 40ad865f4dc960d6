"""Importing this module registers every query."""

from . import q_meta, q_models, q_recipes, q_records, q_scalars, q_stats  # noqa: F401
