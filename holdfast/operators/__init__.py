"""DataFrame building blocks with a stated bound on what one task or the driver holds."""
