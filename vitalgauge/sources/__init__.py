"""Inputs, outputs and shared intermediate tables."""
