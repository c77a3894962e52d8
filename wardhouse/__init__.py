"""Spark jobs that turn messy operational tables into a dimensional warehouse."""
