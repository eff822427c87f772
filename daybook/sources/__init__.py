"""Feed readers, partitioned outputs and warehouse tables."""
