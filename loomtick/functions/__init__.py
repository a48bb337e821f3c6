"""Functions of loomtick."""
