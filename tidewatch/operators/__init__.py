"""Contract rules, the gate, bars, service objectives, the fault laboratory, grading, profiling and publishing."""
