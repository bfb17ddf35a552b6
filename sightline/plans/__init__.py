"""Composed jobs: enriched facts and summary tables."""
