"""The registered queries: the library's models over the driver's tables."""
