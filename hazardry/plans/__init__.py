"""Whole jobs: star-schema load, map view, registered queries and their SQL twins."""
