"""Column builders and the NumPy block kernels used inside Arrow stages."""
