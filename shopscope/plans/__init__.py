"""The analytics themselves: profiling, quality rules, silver, gold, views and reports."""
