"""DataFrame -> DataFrame operators: quality gate, profiles, dimensions, checks."""
