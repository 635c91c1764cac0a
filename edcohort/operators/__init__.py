"""Relational operators: DataFrame -> DataFrame, column names as parameters."""
