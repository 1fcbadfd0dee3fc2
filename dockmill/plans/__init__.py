"""Session helpers, shared storage and the driver-side runners."""
