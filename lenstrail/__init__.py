"""Mobility analytics over geo-tagged photos, written as lazy Spark DataFrame operators."""
