"""Loads: what a user schedules."""
