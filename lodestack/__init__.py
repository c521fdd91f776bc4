"""Corpus and knowledge-base analytics on Spark."""
