"""Column-to-column helpers; all of them stay inside Catalyst."""
