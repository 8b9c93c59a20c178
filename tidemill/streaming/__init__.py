"""Stream forms: state processors, outputs, runs."""
