"""Plans: base relations derived from the driver tables and the query catalogue."""
