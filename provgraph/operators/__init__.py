"""Pipeline stages as DataFrame transformations (one module per stage)."""
