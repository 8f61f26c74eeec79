"""Composed plans: the feature build, the encoder batch, the model matrix
and the per-fold model."""
