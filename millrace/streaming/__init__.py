"""Intentionally empty: every job in scope is a recurring batch job, so there is no stream to build."""
