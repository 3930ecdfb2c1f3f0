"""Moraine: a PySpark-native engine for moving, cleaning and checking relational data."""
