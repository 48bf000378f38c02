"""Jobs composed from the operators (materialize, diff) and the query catalog."""
