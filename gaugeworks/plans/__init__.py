"""Declarative plans: closed contracts, resolvers that prove them, and the proposal loop."""
