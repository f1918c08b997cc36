"""Registered queries over station data derived from the ``events`` table."""
