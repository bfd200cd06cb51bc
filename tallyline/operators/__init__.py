"""DataFrame-in, DataFrame-out operators. No session state, no actions."""
