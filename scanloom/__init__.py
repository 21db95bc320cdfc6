"""Point, grid, trajectory and evidence analytics as Spark DataFrame operators."""
