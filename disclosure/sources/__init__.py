"""Sources: explicit-schema CSV scans, file listings and snapshots, catalog manifests and fetch
planning, the download job, and the inputs derived from the test tables."""
