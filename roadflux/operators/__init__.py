"""Table-level operators; every one is lazy and free of clock reads."""
