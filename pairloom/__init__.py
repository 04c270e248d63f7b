"""Preparing, encoding and scoring labelled text pairs on Spark."""
