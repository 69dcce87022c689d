"""Multi-step work built from the operators."""
