"""Continuous refresh and live figures."""
