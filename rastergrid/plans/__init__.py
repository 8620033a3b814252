"""Whole jobs: export grids and the tile job from orders to stored tiles."""
