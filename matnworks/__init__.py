"""Corpus analytics and authorship detection on Spark."""
