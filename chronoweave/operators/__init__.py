"""DataFrame operators of the engine (each keyed by ``session_id``)."""
