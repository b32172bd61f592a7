"""Reusable column and DataFrame helpers: scalars, reshaping, short and long series."""
