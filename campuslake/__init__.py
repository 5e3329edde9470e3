"""Admissions analytics at population scale, as DataFrame operators."""
