"""Sensitive-data discovery, anonymization and verification as Spark DataFrame operators."""
