"""Plans of loomtick."""
