"""Table operators: canonical values, validation and quarantine, profiling, quality rules."""
