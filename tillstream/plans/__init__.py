"""The registered queries, the entities they run on, and their SQL twins."""
