"""Named business queries, the report tables behind the dashboard pages, and the query catalog."""
