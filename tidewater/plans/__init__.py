"""Table builders (``asn``: pipeline A, ``compliance``: pipeline B), their
registry and declared schemas, the pipelines, and the registered queries."""
