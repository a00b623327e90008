"""Sources (``catalog``, ``standins``) and sinks (``publish``)."""
