"""End-to-end flows built from the operators, and the checked query catalogue."""
