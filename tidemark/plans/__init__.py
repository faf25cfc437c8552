"""Jobs and export sets composed from the operators."""
