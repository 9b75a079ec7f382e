"""Core package."""
