"""Operators: each takes and returns a DataFrame, batch or streaming unless it says otherwise."""
