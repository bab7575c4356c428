"""DataFrame operators. Each takes a frame plus explicit series keys and stays lazy."""
