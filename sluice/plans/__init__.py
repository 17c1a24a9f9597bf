"""Multi-step jobs (writes, round trips, batch loads) and the query suite."""
