"""Table readers and writers, control logs, and the input views over the test tables."""
