"""Named queries over the driver's test tables, with their SQL oracles."""
