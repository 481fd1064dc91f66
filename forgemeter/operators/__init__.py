"""DataFrame operators. Each works on batch and on streaming input unless it says otherwise."""
