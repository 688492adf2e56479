"""Table operators: `DataFrame -> DataFrame`."""
