"""Whole loads: warehouse tables, the tick load and the star load."""
