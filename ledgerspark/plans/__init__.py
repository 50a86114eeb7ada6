"""Composite transforms (T1-T6) and the jobs built from them (Q1-Q12)."""
