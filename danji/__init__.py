"""Apartment-market analytics as lazy Spark DataFrame plans."""
