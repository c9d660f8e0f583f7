"""Ledgerlake: an anti-money-laundering transaction warehouse built from Spark DataFrames."""
