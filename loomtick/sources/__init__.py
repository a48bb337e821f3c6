"""Sources of loomtick."""
