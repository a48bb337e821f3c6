"""Streaming of loomtick."""
