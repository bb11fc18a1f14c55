"""Actions: table writes, range reloads, documents."""
