"""Reading landing files, tables and the test tables."""
