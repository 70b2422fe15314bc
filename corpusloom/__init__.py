"""Corpusloom: evidence-grounded corpus analytics as Spark DataFrame plans."""
