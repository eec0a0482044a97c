"""Feed specifications and the runs that follow them."""
