"""Composed plans: whole-article extraction (F20) and the detect API (Q1/Q2)."""
