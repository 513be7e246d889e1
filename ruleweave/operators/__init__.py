"""Relational operators of the detection engine, written as DataFrame plans."""
