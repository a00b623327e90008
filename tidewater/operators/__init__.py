"""DataFrame operators shared by the builders (``ops``)."""
