"""Reading feeds and writing results."""
