"""Writers of results; none of them brings rows to the driver."""
