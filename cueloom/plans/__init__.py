"""Whole stages composed of operators."""
