"""Sources: landing CSV directories, the registry table, the states dimension."""
