"""The analytics: windows, aggregates, rankings, joins, patterns, detection."""
