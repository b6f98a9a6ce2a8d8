"""The daily jobs, and the queries registered with the driver."""
