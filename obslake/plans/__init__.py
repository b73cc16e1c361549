"""Plans over the driver tables: the stand-in mapping, the three scheduled
jobs (Load, Train, Score) and the registered query catalog with oracles."""
