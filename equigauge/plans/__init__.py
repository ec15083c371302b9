"""Policy evaluation built from the operators: controls in, results out."""
