"""End-to-end jobs: posting pipeline, notebook analyses, driver queries."""
