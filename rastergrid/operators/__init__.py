"""DataFrame operators: pyramids, dates, catalog, tiles, pixels, regions and styles."""
