"""Waste-container data operations written as Spark DataFrame functions."""
