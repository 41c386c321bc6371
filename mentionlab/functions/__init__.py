"""Column functions (no DataFrame in, Column out) shared by batch and stream."""
