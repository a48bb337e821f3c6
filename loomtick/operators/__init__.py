"""Operators of loomtick."""
