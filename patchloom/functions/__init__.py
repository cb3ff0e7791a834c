"""Column functions: keys, time, encoding, vectors and pixels."""
