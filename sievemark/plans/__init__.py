"""Plan helpers: table access and lineage cuts."""
