"""Reading inbound data and writing results."""
