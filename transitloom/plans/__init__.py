"""Cleaned tables, fleet measures, dashboard answers and the jobs that write them."""
