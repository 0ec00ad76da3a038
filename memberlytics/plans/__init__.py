"""The four batch jobs, composed from the operators."""
