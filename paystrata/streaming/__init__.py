"""The two streaming jobs: clean-and-enrich, and windows."""
