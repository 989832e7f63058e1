"""Whole jobs: monthly loads, indicator tables, forecast, allocation, publishing, audit."""
