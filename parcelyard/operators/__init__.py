"""Frame-to-frame steps of the refresh. Each one only builds a plan."""
