"""Model-assisted operators: prompts, a pluggable provider with a deterministic offline default, budgets and parsing."""
