"""Column functions: paths, text, cue clocks, signals, edit distance."""
