"""Job configurations and the jobs composed from the operators."""
