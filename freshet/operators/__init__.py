"""DataFrame-to-DataFrame operators. Each returns a lazy plan unless it says otherwise."""
