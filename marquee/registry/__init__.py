"""The queries registered with the driver, and their SQL counterparts."""
