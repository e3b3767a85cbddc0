"""Scalar kernels as native Column expressions."""
