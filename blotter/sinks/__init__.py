"""Writing tables and exports."""
