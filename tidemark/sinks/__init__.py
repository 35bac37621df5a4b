"""Writers: day partitions replaced as a whole, appended or fully refreshed."""
