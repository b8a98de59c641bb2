"""DataFrame -> DataFrame operators of the activity pipeline."""
