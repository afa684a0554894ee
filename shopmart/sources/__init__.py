"""Inputs and outputs: raw snapshots (plain or bucketed), the test-data
projection, versioned tables, CSV staging, SQL dump rows."""
