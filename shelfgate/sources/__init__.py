"""Sources and sinks: landing-folder catalog, listing scans, fixtures, writers."""
