"""Column expressions: paths, times, lanes, labels and boxes. Nothing here runs Python per row."""
