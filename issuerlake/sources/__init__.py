"""Readers: every one declares its schema and leaves filtering and pruning to the planner."""
