"""Data classification and role-aware access control on Spark DataFrames."""
