"""DataFrame operators: rules, analyzers, validation, gates, entities, payloads, metrics."""
