"""Operators for building large text corpora, each a Spark job of its own."""
