"""Plans: table builders, the derived catalog, questions, loads, quality."""
