"""The reports: functions from input tables to one report DataFrame."""
