"""Building blocks for skew-proof plans: ordered scans, exact quantiles, block products."""
