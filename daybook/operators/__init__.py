"""Feed processing, price joins, rejects, metrics, gate and data contracts."""
