"""Plan shapes several operators share, and the registered queries."""
