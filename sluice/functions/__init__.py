"""Column expressions: rules, time helpers, text helpers, tie-broken extremes."""
