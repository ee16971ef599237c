"""Streaming forms of the analyses and a runner for them."""
