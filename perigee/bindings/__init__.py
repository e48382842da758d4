"""The domain tables derived from the driver's star schema, the query registry and its SQL checks."""
