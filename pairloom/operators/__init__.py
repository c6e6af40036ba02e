"""DataFrame operators: examples, description, parameters, scoring, training steps, evaluation."""
