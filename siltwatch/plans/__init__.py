"""Multi-operator plans: monitoring, training, evaluation, detection flow."""
