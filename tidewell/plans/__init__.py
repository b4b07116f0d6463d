"""End-to-end flows and reporting queries built from the operators."""
