"""Where frames and change logs come from."""
