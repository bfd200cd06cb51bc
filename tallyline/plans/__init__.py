"""Whole stories: operators put together, with their checks."""
