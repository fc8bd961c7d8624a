"""Sources: table readers, CSV files, arrival events, run results, generator."""
