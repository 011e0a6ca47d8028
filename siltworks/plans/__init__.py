"""Plans made of the operators: the trip tables, and the same plans on the test tables."""
