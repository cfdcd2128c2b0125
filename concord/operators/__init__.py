"""DataFrame operators: frames and parameters in, a lazy frame out."""
