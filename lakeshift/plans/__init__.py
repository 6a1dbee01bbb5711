"""Frames derived from the shared test tables, registered queries and their oracle SQL."""
