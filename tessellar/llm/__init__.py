"""Operators for building training data: sketches, stable samples, leakage, mixing and language labels. Nothing else imports this package."""
