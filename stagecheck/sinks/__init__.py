"""Writers: stored tables, reports, archives, extracts."""
