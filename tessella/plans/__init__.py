"""What to render: tiles of footprints, map areas, the catalog of series."""
