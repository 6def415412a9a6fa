"""Presets that wire the operators together: the ratings warehouse and its runs."""
