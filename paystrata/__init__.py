"""A payment-transaction warehouse written as PySpark DataFrame functions."""
