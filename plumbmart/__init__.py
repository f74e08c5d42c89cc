"""Governed tabular marts on Spark: raw strings in, audited star schema out."""
