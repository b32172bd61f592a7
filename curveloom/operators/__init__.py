"""Domain operators. Each takes and returns DataFrames and builds one lazy plan."""
