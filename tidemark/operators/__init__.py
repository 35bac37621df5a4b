"""Reusable DataFrame operators the reports are put together from."""
