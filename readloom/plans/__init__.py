"""Jobs and registered queries built from the operators."""
