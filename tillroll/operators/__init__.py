"""Operators: frames and parameters in, a frame out."""
