"""Operators over DataFrames; each takes its keys and orders as parameters and names its ties."""
