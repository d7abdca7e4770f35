"""Stream wiring: sources, the shared operators, and sinks with checkpoints."""
