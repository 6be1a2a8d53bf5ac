"""DataFrame-level operators: staging, hierarchy, spatial join, snapshots,
forecast marts, read queries, data checks and the declared models."""
