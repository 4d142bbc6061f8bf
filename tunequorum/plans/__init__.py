"""Jobs composed of operators: training, serving, evaluation, tuning."""
