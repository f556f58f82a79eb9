"""Scalar rules as Column builders, with driver-side twins for plan constants."""
